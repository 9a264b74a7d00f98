"""Benchmark decontamination with suffix arrays of the training texts.

Every shard of training texts gets a suffix array of its words. Each suffix of each
benchmark item is searched in it by bisection, word by word, which gives the longest
verbatim match from there and all places where it stands. An item's windows (``WINDOW``
consecutive words, or the whole item where it has fewer) occur where the match of a
suffix reaches that far; training words inside an occurrence are hit, and a text of
which a twentieth or more is hit is contaminated.

A shard is a piece of one task's input, so shards need no shuffle and no order. Its
array leaves out the suffixes whose first two words no item has: no search could end
there. Words are compared by 64-bit hashes; any order of words will do for bisection.

Equal item suffixes, equal ranges of an array and equal sets of windows are classes that
are worked on once, so a passage that many items and texts share, or a text of one
repeated word, forms no pairs of item and text places.

Benchmark items are searched in blocks of at most ``BLOCK_BYTES``, so that what is sent
to executors is bounded; a larger benchmark takes more passes, and the texts are written
between them.

Cases: null and empty texts have no words and no hit; null and empty items have no
window. Items with the same id are one item with the windows of all; an item without an
id is searched but not named. Repeated rows get equal results. An empty table gives no
rows; an empty benchmark hits nothing. Columns of the input with the names of the
output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from blotterflow.llm.batches import TEXT, append_columns, hidden
from blotterflow.llm.tables import discard, stored
from blotterflow.llm.words import ALNUM, FOLD, Runs, covered, mix, split_words

WINDOW = 13
#: Bytes of benchmark text sent to executors at once.
BLOCK_BYTES = 4 << 20
SIEVE = 1 << 22
#: Words by which suffixes are sorted one at a time.
ROUNDS = 32

FIELDS = [
    StructField("n_words", LongType()),
    StructField("n_hit", LongType()),
    StructField("item_ids", ArrayType(StringType())),
    StructField(
        "matches",
        ArrayType(
            StructType(
                [
                    StructField("item_id", StringType()),
                    StructField("item_word", IntegerType()),
                    StructField("text_word", IntegerType()),
                    StructField("words", IntegerType()),
                ]
            )
        ),
    ),
    StructField("match_sharers", ArrayType(LongType())),
]


class Items:
    """The suffixes of a block of benchmark items; equal ones are one, known by its first place."""

    def __init__(self, ids: list[str | None], texts: list[str | None]):
        words = split_words(pa.array(texts, pa.string()), ALNUM, FOLD)
        self.ids = np.array(ids, object)
        self.words = words.hashes()
        self.item, end = words.text_of(), words.last()
        self.place = np.arange(len(self.words)) - words.first[:-1][self.item]
        left = end - np.arange(len(self.words))
        need = np.minimum(words.counts[self.item], WINDOW)
        # suffixes shorter than a window of their item can't hold one
        useful = np.flatnonzero(left >= need)
        self.runs = runs = Runs(self.words)
        _, first, kind, count = np.unique(
            np.stack([runs.of(useful, end[useful]), left[useful].astype(np.uint64), need[useful].astype(np.uint64)]),
            axis=1, return_index=True, return_inverse=True, return_counts=True,
        ) if len(useful) else (None, *[np.zeros(0, np.int64)] * 3)
        order = np.argsort(first)
        self.at, self.count = useful[first[order]], count[order]
        self.left, self.need = left[self.at], need[self.at]
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        self.distinct, self.code = np.unique(self.words, return_inverse=True)
        # the names of the items of each kind of suffix, in one array
        self.names = sorted({i for i in ids if i is not None})
        known = {name: n for n, name in enumerate(self.names)}
        name = np.array([known.get(i, -1) for i in ids], np.int64)[self.item[useful]]
        named = np.unique(number[kind.reshape(-1)][name >= 0] * max(len(known), 1) + name[name >= 0])
        owner, self.name = np.divmod(named, max(len(known), 1))
        self.name_from = np.searchsorted(owner, np.arange(len(order) + 1))
        self.depth = int(self.left.max(initial=0))
        self.sieve = np.zeros(SIEVE, bool)
        self.sieve[self._slot(runs.all(2)[np.flatnonzero(left >= 2)])] = True
        self.alone = np.unique(self.words[need == 1])

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(40)).astype(np.int64) % SIEVE

    def reachable(self, words: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The training suffixes that some search could reach."""
        if not len(words):
            return np.zeros(0, np.int64)
        hit = np.zeros(len(words), bool)
        hit[:-1] = self.sieve[self._slot(Runs(words).all(2))[: len(words) - 1]]
        hit[:-1] &= np.arange(len(words) - 1) + 1 < last[:-1]
        if len(self.alone):
            hit |= np.isin(words, self.alone)
        return np.flatnonzero(hit)


def suffix_array(words: np.ndarray, last: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """``places`` in the order of the words from there to their text's end, compared up to ``depth`` words.

    Sorted by one more word in each round; only suffixes that are still equal go on, and
    those that are so after ``ROUNDS`` words are sorted by ranks of doubled length.
    """
    order = places.copy()
    low, high = np.zeros(1, np.int64), np.array([len(order)])  # runs of equal suffixes
    for d in range(depth):
        sizes = high - low
        low, sizes = low[sizes > 1], sizes[sizes > 1]
        if not len(low):
            break
        run = np.repeat(np.arange(len(low)), sizes)
        at = _expand(low, sizes)
        here = order[at]
        if d == ROUNDS:
            order[at] = here[np.lexsort((_ranks(words, last, here, depth), run))]
            break
        key, over = _word(words, last, here, d)
        by = np.lexsort((key, ~over, run))
        order[at] = here[by]
        key, over, run = key[by], over[by], run[by]
        new = np.ones(len(run), bool)
        new[1:] = (run[1:] != run[:-1]) | (key[1:] != key[:-1]) | (over[1:] != over[:-1])
        starts = np.flatnonzero(new)
        low, high = at[starts], at[np.append(starts[1:], len(run)) - 1] + 1
        live = ~over[starts]
        low, high = low[live], high[live]
    return order


def _ranks(words, last, places, depth):
    """Ranks of suffixes by at least ``depth`` words, doubled in length each round; equal ones have equal ranks."""
    near = np.flatnonzero(covered(len(words), places, last[places] - places))  # all that follows a place in its text
    number = np.zeros(len(words), np.int64)
    number[near] = np.arange(len(near))
    left = last[near] - near
    rank = np.unique(words[near], return_inverse=True)[1] + 1
    size = 1
    while size < depth and rank.max() < len(near):
        ahead = np.zeros(len(near), np.int64)  # beyond the text's end: before any word
        inside = np.flatnonzero(left > size)
        ahead[inside] = rank[inside + size]
        rank = np.unique(rank * (len(near) + 1) + ahead, return_inverse=True)[1] + 1
        size *= 2
    return rank[number[places]]


def _expand(low, sizes):
    """All numbers from each ``low`` on, ``sizes`` of them."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)


def _word(words, last, places, depth):
    """The word ``depth`` behind each place, and whether the text has ended before it."""
    at = places + depth
    over = at >= last[places]
    return words[np.minimum(at, len(words) - 1)], over


def bisect(words, last, array, depth, low, high, wanted, right: bool):
    """In each range of the array, where the word at its depth reaches (or passes) the wanted one."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        middle = (low[open_] + high[open_]) // 2
        key, over = _word(words, last, array[middle], depth[open_])
        before = over | ((key <= wanted[open_]) if right else (key < wanted[open_]))
        low[open_[before]] = middle[before] + 1
        high[open_[~before]] = middle[~before]


def longest_matches(items: Items, words, last, array):
    """The longest match of each slot of the array, and the windows that occur.

    All kinds of item suffixes are bisected together, word by word (behind the windows,
    on to the next word where a range parts): those that agree so
    far share one range of the array, as equal words have one range, so neither their
    pairs with places nor copies of a passage are gone through. A place gets its length
    when it leaves the ranges, once. Given are length, item place and number of item
    places that share it, per slot (0: none), and (low, high, kind) of every window:
    where in the array it stands, and each kind of suffix that begins with it.
    """
    longest = np.zeros((3, len(array)), np.int64)
    windows = [np.zeros((3, 0), np.int64)]
    shard = Runs(words)
    kind, state = np.arange(len(items.at)), np.zeros(len(items.at), np.int64)
    low, high, depth = np.zeros(1, np.int64), np.array([len(array)]), np.zeros(1, np.int64)
    got = np.zeros((3, 1), np.int64)  # of each range: the longest match so far, as in ``longest``
    steps = 0
    while len(low) and len(array):
        if steps >= WINDOW:  # all windows are behind: on to where a range parts
            common = np.full(len(low), len(words))
            for end in (low, high - 1):
                np.minimum.at(common, state, _agreement(items, shard, last, kind, array[end[state]], depth[state]))
            depth = depth + common
            got[0] = depth
        on = items.left[kind] > depth[state]
        kind, state = kind[on], state[on]
        code = items.code[items.at[kind] + depth[state]]
        key, child = np.unique(state * len(items.distinct) + code, return_inverse=True)
        parent, wanted = np.divmod(key, len(items.distinct))
        wanted = items.distinct[wanted]
        new_low = bisect(words, last, array, depth[parent], low[parent], high[parent], wanted, False)
        new_high = bisect(words, last, array, depth[parent], new_low, high[parent], wanted, True)
        live = new_low < new_high
        _leave(longest, got, low, high, parent[live], new_low[live], new_high[live])
        steps += 1
        number = np.cumsum(live) - 1
        kind, state = kind[live[child]], number[child[live[child]]]
        low, high, depth, got = new_low[live], new_high[live], depth[parent[live]] + 1, got[:, parent[live]]
        long = items.need[kind] <= depth[state]
        if long.any():
            order = np.argsort(state[long], kind="stable")
            mine, k = state[long][order], kind[long][order]
            starts = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
            sharers = np.add.reduceat(items.count[k], starts)
            got[:, mine[starts]] = depth[mine[starts]], items.at[k[starts]], sharers
        if steps <= WINDOW:
            full = items.need[kind] == steps
            windows.append(np.stack([low[state[full]], high[state[full]], kind[full]]))
    return longest, np.concatenate(windows, axis=1)


def _agreement(items: Items, shard: Runs, last, kind, place, depth):
    """How many words behind ``depth`` each item suffix and the text from each place have in common."""
    a, b = items.at[kind] + depth, place + depth
    low, high = np.zeros(len(kind), np.int64), np.minimum(items.left[kind] - depth, last[place] - b)
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_] + 1) // 2
        same = items.runs.of(a[open_], a[open_] + middle) == shard.of(b[open_], b[open_] + middle)
        low[open_[same]] = middle[same]
        high[open_[~same]] = middle[~same] - 1
    return low


def _leave(longest, got, low, high, parent, child_low, child_high):
    """Notes the match of the places of each range that lie in none of its children."""
    owner = np.append(np.arange(len(low)), parent)
    starts, ends = np.append(low, child_high), np.append(high, child_low)
    first, second = np.lexsort((starts, owner)), np.lexsort((ends, owner))
    owner, start, size = owner[first], starts[first], ends[second] - starts[first]
    some = (size > 0) & (got[0, owner] > 0)
    owner, start, size = owner[some], start[some], size[some]
    longest[:, _expand(start, size)] = np.repeat(got[:, owner], size, axis=1)


def _names_of_texts(items: Items, windows, text, n):
    """The names of the items that have a window in each text, as offsets and one array of numbers.

    Windows of equal places in the array are one class; classes with equal sets of
    names, and texts with equal sets of classes, are worked out once.
    """
    low, high, kind = windows
    wide = int(high.max(initial=0)) + 1
    key, of = np.unique(low * wide + high, return_inverse=True)
    low, high = np.divmod(key, wide)
    count = items.name_from[kind + 1] - items.name_from[kind]
    owner, name = _distinct(np.repeat(of, count), items.name[_expand(items.name_from[kind], count)])
    some, owner = np.unique(owner, return_inverse=True)
    low, high = low[some], high[some]
    alike, which = _alike(owner, name, len(some))
    where, group = _distinct(text[_expand(low, high - low)], np.repeat(which, high - low))
    texts, where = np.unique(where, return_inverse=True)
    same, which = _alike(where, group, len(texts))
    # each set of classes once: the names of its classes
    once = same[which[where]] == where
    of, group = which[where[once]], alike[group[once]]
    from_ = np.searchsorted(owner, np.arange(len(some) + 1))
    size = np.diff(from_)[group]
    of, name = _distinct(np.repeat(of, size), name[_expand(from_[group], size)])
    from_ = np.searchsorted(of, np.arange(len(same) + 1))
    sizes = np.zeros(n, np.int64)
    sizes[texts] = np.diff(from_)[which]
    return np.append(0, np.cumsum(sizes)), name[_expand(from_[which], sizes[texts])]


def _distinct(a, b):
    """Distinct pairs, sorted."""
    width = int(b.max(initial=0)) + 1
    return np.divmod(np.unique(a * width + b), width)


def _alike(owner, member, n):
    """The first owner of each distinct set of members, and the number of each owner's set."""
    sums = np.zeros(n, np.uint64)
    np.add.at(sums, owner, mix(member.astype(np.uint64) + np.uint64(1)))
    _, first, which = np.unique(sums, return_index=True, return_inverse=True)
    return first, which


def _search(items: Items):
    names = pa.array(items.names, pa.string())

    def work(piece: pa.RecordBatch):
        words = split_words(piece.column(TEXT), ALNUM, FOLD)
        hashes, last, text = words.hashes(), words.last(), words.text_of()
        array = suffix_array(hashes, last, items.reachable(hashes, last), items.depth)
        longest, windows = longest_matches(items, hashes, last, array)
        match = np.zeros((3, len(hashes)), np.int64)
        match[:, array] = longest
        length = match[0]
        place = np.flatnonzero(length)
        hit = np.append(covered(len(hashes), place, length[place]), False)
        n_hit = np.add.reduceat(hit.astype(np.int64), words.first[:-1]) * (words.counts > 0)
        offsets, named = _names_of_texts(items, windows, text[array], piece.num_rows)

        # a match that one word earlier began as well is the tail of that one
        tail = (place > words.first[text[place]]) & (length[place - 1] == length[place] + 1)
        place = place[~tail]
        _, suffix, sharers = match[:, place]
        matches = pa.StructArray.from_arrays(
            [
                pa.array(items.ids[items.item[suffix]], pa.string()),
                pa.array(items.place[suffix].astype(np.int32)),
                pa.array((place - words.first[text[place]]).astype(np.int32)),
                pa.array(length[place].astype(np.int32)),
            ],
            names=["item_id", "item_word", "text_word", "words"],
        )
        at = pa.array(np.searchsorted(text[place], np.arange(piece.num_rows + 1)).astype(np.int32))
        return (
            pa.array(words.counts.astype(np.int64)),
            pa.array(n_hit),
            pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), names.take(pa.array(named))),
            pa.ListArray.from_arrays(at, matches),
            pa.ListArray.from_arrays(at, pa.array(sharers)),
        )

    return work


def blocks_of_items(benchmark: DataFrame, id_col: str, text_col: str, limit: int = BLOCK_BYTES):
    """Items in blocks of at most about ``limit`` bytes, one at a time."""
    given = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    total = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // limit)
    for block in range(n):
        mine = given if n == 1 else given.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == block)
        rows = mine.orderBy("id", "text").collect()
        yield Items([r.id for r in rows], [r.text for r in rows])


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with n_words, n_hit, item_ids (sorted), matches, match_sharers and contaminated.

    ``matches`` has the longest match from each place of the text that is no tail of the
    one a word earlier, with the first item place that gives it; ``match_sharers`` tells
    how many item places do. With more than one block, both hold those of each block.
    """
    context = docs.sparkSession.sparkContext
    out, before = docs, []
    more = [f.name for f in FIELDS]
    sent = None
    for items in blocks_of_items(benchmark, item_id_col, item_text_col, block_bytes):
        if sent is not None:
            # written between blocks, so that no task holds the workers and items of several
            out = stored(out, "contamination")
            sent.unpersist()
            before.append(out)
            discard(*before[:-1])
            before = before[-1:]
        names = [f"_llm_{n}" for n in more] if before else more
        sent = context.broadcast(items)
        fields = [StructField(n, f.dataType) for n, f in zip(names, FIELDS, strict=True)]
        out = append_columns(out, text_col, fields, lambda sent=sent: _search(sent.value))
        if before:
            out = _merge(out, names)
    if sent is None:
        none = Items([], [])
        out = append_columns(out, text_col, FIELDS, lambda: _search(none))
    contaminated = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return out.withColumn("contaminated", contaminated)


def _merge(out: DataFrame, names: list[str]) -> DataFrame:
    """The hits of one more block of items; overlapping spans count once."""
    matches = F.concat("matches", names[3])
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["text_word"].alias("a"), (m["text_word"] + m["words"]).alias("b"))))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    hit = F.aggregate(
        spans,
        start,
        lambda s, x: F.struct(
            F.greatest(s["end"], x["b"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(s["end"], x["a"]))).alias("n"),
        ),
        lambda s: s["n"],
    )
    return out.withColumns(
        {
            "n_hit": hit,
            "item_ids": F.array_sort(F.array_union("item_ids", names[2])),
            "matches": matches,
            "match_sharers": F.concat("match_sharers", names[4]),
        }
    ).drop(*names)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, as they are."""
    given = hidden(docs)
    text = given.columns[docs.columns.index(text_col)]
    return contamination(given, benchmark, text).where("not contaminated").select(given.columns).toDF(*docs.columns)
