"""Exact merge-type encoding by backtracking, and decoding, for SentencePiece BPE models.

Merging joins, again and again, the neighbouring pieces whose joined piece has the best
score. The same result comes out without merging: a sequence of pieces is the encoding
if and only if each two neighbours are *compatible*, that is, if merging their joined
text gives these two pieces back. So a text is read from the left, taking the longest
piece that fits (found by walking the trie of pieces from each place reached), a shorter
one where the pair is not compatible, and going back where none is. A bitfield of places
from which no encoding goes on keeps this linear.

Whether a pair is compatible is found by taking its two pieces apart, the later merged
one first, and looking for a pair along the border that would have been merged earlier
than what stands there. Answers are remembered.

No merge crosses a border between two characters that no piece has side by side. No
piece has a blank behind another character, so texts fall into chunks there, and these
into smaller ones at all other such borders. Recent chunks are remembered, as words
come again. (A model with blanks inside pieces is encoded in one chunk.)
"""

from __future__ import annotations

import codecs
import re
from array import array

import ahocorasick
import numpy as np

BLANK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Chunks and pairs remembered by a worker, and the longest chunk that is.
REMEMBERED, LONGEST = 250_000, 64


class Model:
    """The tables of a model: bounded by its vocabulary, and made once on the driver.

    Pieces are numbered by merge order here: single characters first, then merged
    pieces from the best score on; ``ids`` has the model's numbers.
    """

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        if proto.trainer_spec.model_type != 2 or not proto.trainer_spec.byte_fallback:
            raise ValueError("only BPE models with byte fallback are supported")
        if proto.normalizer_spec.precompiled_charsmap or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave texts as they are are supported")
        kinds = [p.type for p in proto.pieces]
        if USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.prefix = proto.normalizer_spec.add_dummy_prefix
        self.bytes = [0] * 256
        self.surface: list[bytes] = []
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:-1], 16)
                self.bytes[value] = i
                self.surface.append(bytes([value]))
            elif p.type == UNKNOWN:
                self.surface.append(proto.trainer_spec.unk_surface.encode())
            else:
                self.surface.append(b"" if p.type == CONTROL else p.piece.replace(BLANK, " ").encode())
        self.plain = [k == NORMAL for k in kinds]
        self.silent = np.flatnonzero(np.array(kinds) == CONTROL)

        normal = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type == NORMAL}
        merged = sorted((w for w in normal if len(w) > 1), key=lambda w: (-normal[w][1], normal[w][0]))
        single = sorted({c for w in normal for c in w})
        self.chunked = not any(re.search(f"[^{BLANK}]{BLANK}", w) for w in merged)
        order = {w: r for r, w in enumerate(single + merged)}
        self.words: list[str] = []
        self.left: list[int] = []
        self.right: list[int] = []
        self.ids: list[int | None] = []
        self.joined: dict[tuple[int, int], int] = {}
        number: dict[str, int] = {}
        for w in single + merged:
            halves = _last_merge(w, order)
            if len(w) > 1 and halves is None:
                continue  # merging never makes this piece
            r = number[w] = len(self.words)
            a, b = (number[x] for x in halves) if halves else (r, r)
            self.words.append(w)
            self.left.append(a)
            self.right.append(b)
            self.ids.append(normal[w][0] if w in normal else None)
            if halves:
                self.joined[a, b] = r


def _last_merge(word: str, order: dict[str, int]) -> tuple[str, str] | None:
    """The two pieces that merging ``word`` alone joins at last; None if it doesn't become one piece."""
    parts, last = list(word), None
    while len(parts) > 1:
        best = min((order.get(a + b, len(order)), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if best[0] == len(order):
            return None
        i = best[1]
        last = parts[i], parts[i + 1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return last


class _Chunks(dict):
    """Encoded chunks, as the bytes of 32-bit ids."""

    def __init__(self, encode):
        self.encode = encode

    def __missing__(self, chunk):
        ids = self.encode(chunk)
        if len(chunk) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[chunk] = ids
        return ids


class Codec:
    def __init__(self, model: Model):
        self.model = model
        self.automaton = ahocorasick.Automaton()
        for r, w in enumerate(model.words):
            self.automaton.add_word(w, (len(w), r))
        self.automaton.make_automaton()
        self.shorter = [self._shorter(w) for w in model.words]
        self.reach = max(map(len, model.words), default=1)
        self.paths: dict[str, int] = {}
        self.side_by_side = {w[i : i + 2] for w in model.words for i in range(len(w) - 1)}
        self.sizes = [len(w) for w in model.words]
        self.known = {w for w in model.words if len(w) == 1}
        self.pairs: dict[int, bool] = {}
        self.chunks, self.parts = _Chunks(self.encode_chunk), _Chunks(self.encode_part)
        self.split = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+" if model.chunked else "(?s:.+)").findall

    def forget(self) -> None:
        for remembered in (self.chunks, self.parts, self.pairs):
            remembered.clear()

    def _shorter(self, word: str) -> int:
        """The longest piece that ``word`` begins with and isn't, or -1."""
        for n in range(len(word) - 1, 0, -1):
            found = self.automaton.get(word[:n], None)
            if found:
                return found[1]
        return -1

    def compatible(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[key] = self._merge_again(a, b)
        return known

    def _merge_again(self, a: int, b: int) -> bool:
        """Whether no pair along the border of ``a`` and ``b`` is merged before the pieces beside it."""
        joined, left, right = self.model.joined, self.model.left, self.model.right
        limit = len(left) + 1
        while True:
            if joined.get((a, b), limit) < limit:
                return False
            # undo the later of the two merges; of equals, the right one was later
            part_a, part_b = right[a], left[b]
            if part_a != a and (a > b or part_b == b):
                limit, a = a, part_a
            elif part_b != b:
                limit, b = b + 1, part_b
            else:
                return True

    def longest(self, text: str, at: int) -> int:
        """The longest piece that stands at a place; its character is known."""
        window = text[at : at + self.reach]
        path = window[: self.automaton.longest_prefix(window)]
        token = self.paths.get(path)
        if token is None:  # the automaton may have gone on towards a longer piece than there is
            found = self.automaton.get(path, None)
            token = self.paths[path] = found[1] if found else self._shorter(path)
        return token

    def encode_run(self, text: str) -> list[int]:
        """Pieces of a text whose characters are all known."""
        sizes, shorter, compatible, longest = self.sizes, self.shorter, self.compatible, self.longest
        n, out, at = len(text), [], 0
        failed = bytearray(n // 8 + 1)  # a bit for each place from which no encoding goes on
        token = longest(text, 0)
        while at < n:
            before = out[-1] if out else -1
            while True:
                end = at + sizes[token]
                if not failed[end >> 3] >> (end & 7) & 1 and (before < 0 or compatible(before, token)):
                    out.append(token)
                    at = end
                    if at < n:
                        token = longest(text, at)
                    break
                if shorter[token] >= 0:
                    token = shorter[token]
                else:
                    failed[at >> 3] |= 1 << (at & 7)
                    token = out.pop()
                    at -= sizes[token]
                    break
        return out

    def encode_chunk(self, chunk: str) -> bytes:
        side, start, out = self.side_by_side, 0, []
        for i, (a, b) in enumerate(zip(chunk, chunk[1:]), 1):
            if a + b not in side:
                out.append(self.parts[chunk[start:i]])
                start = i
        out.append(self.parts[chunk[start:]])
        return b"".join(out)

    def encode_part(self, part: str) -> bytes:
        """Ids of characters that stand side by side in pieces; one alone may be unknown."""
        if part in self.known or len(part) > 1:
            ids = self._ids(part, self.model.ids)
        else:
            ids = [self.model.bytes[x] for x in part.encode()]
        return array("i", ids).tobytes()

    def _ids(self, text: str, ids: list) -> list[int]:
        out = []
        for r in self.encode_run(text):
            if ids[r] is None:
                out += [self.model.bytes[x] for x in self.model.words[r].encode()]
            else:
                out.append(ids[r])
        return out

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        text = text.replace(" ", BLANK)
        if self.model.prefix:
            text = BLANK + text
        return np.frombuffer(b"".join(map(self.chunks.__getitem__, self.split(text))), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; every byte that is not UTF-8 becomes U+FFFD."""
        surface, silent = self.model.surface, self.model.silent
        parts = np.split(ids, np.flatnonzero(np.isin(ids, silent))) if len(silent) else [ids]
        text = "".join(b"".join([surface[i] for i in part.tolist()]).decode("utf-8", "each_byte") for part in parts)
        spoken = ids[~np.isin(ids, silent)][:1]
        if self.model.prefix and len(spoken) and self.model.plain[spoken[0]]:
            text = text.removeprefix(" ")
        return text


def _each_byte(error):
    return "�" * (error.end - error.start), error.end


codecs.register_error("each_byte", _each_byte)
