"""Plain versions of the operators, for comparison on small tables."""

from __future__ import annotations

import hashlib
import re

import xxhash

BLANK = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def substring_dedup(rows, window=20):
    """rows: (doc_id, text). doc_id -> (n_words, n_removed, kept_sha256)."""
    words = {i: BLANK.findall(t or "") for i, t in rows}
    seen, out = set(), {}
    for i in sorted(words):
        w, gone = words[i], set()
        for at in range(len(w) - window + 1):
            run = tuple(w[at : at + window])
            if run in seen:
                gone.update(range(at, at + window))
            seen.add(run)
        out[i] = (len(w), len(gone), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def fold(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def simhash(text: str | None) -> int:
    w = BLANK.findall(fold(text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 4]).encode(), 42) for k in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints, limit=4):
    """prints: (doc_id, fingerprint). doc_id -> component_id."""
    prints = list(prints)
    root = {i: i for i, _ in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(prints):
        for j, b in prints[:n]:
            if (a ^ b).bit_count() <= limit:
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: find(i) for i, _ in prints}


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def contamination(rows, items, window=13):
    """rows: (doc_id, text); items: (item_id, text). doc_id -> (n_words, n_hit, items, contaminated)."""
    windows = {}
    for name, text in items:
        w = ALNUM.findall(fold(text or ""))
        size = min(window, len(w))
        for at in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[at : at + size]), set()).add(name)
    sizes, out = {len(w) for w in windows}, {}
    for i, text in rows:
        w, hit, names = ALNUM.findall(fold(text or "")), set(), set()
        for size in sizes:
            for at in range(len(w) - size + 1):
                if (run := tuple(w[at : at + size])) in windows:
                    hit.update(range(at, at + size))
                    names |= {str(n) for n in windows[run] if n is not None}
        out[i] = (len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w))
    return out
