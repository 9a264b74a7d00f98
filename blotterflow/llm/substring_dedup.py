"""Substring dedup: seed and extend over winnowed anchors.

A word that lies in a window of ``WINDOW`` consecutive words whose sequence also
starts earlier (in a smaller id, or earlier in the same text) is removed.

*Seed.* Every window picks one anchor, the least hash of its ``ANCHOR``-word runs
(the last of equals), so equal windows pick equal anchors. Neighbouring windows that
pick the same anchor form a block, and only blocks travel: one row for about seven
words. Anchors seen in one block only are gone after the first aggregate.

*Extend.* A block is its anchor extended both ways as far as the windows that picked
it reach. Where all blocks of an anchor are the same words, every later block is a
repeat. Where they differ, blocks are compared as classes of equal words, and the
first block of each class is taken apart into windows, which are compared by their
own hashes. Touching repeats are joined into maximal ones in the text itself; repeats
within a text are found there as well.

No pair of rows is ever formed: each step compares a row with the least id of its key,
so a passage shared by a third of all texts costs one row for each text.

Keys are hashes of 64 bits for the anchor and 64 for the words around it; spans are
checked against the words of the text they are applied to.

Cases: null and empty texts have no words. A null id comes after all others. Rows with
the same id: neither is earlier than the other; each text is judged by smaller ids and
by itself. A text with fewer than ``WINDOW`` words loses nothing. An empty table gives
no rows. Columns of the input with the names of the output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from blotterflow.llm.batches import TEXT, append_columns, pieces, strings
from blotterflow.llm.tables import discard, stored
from blotterflow.llm.words import Runs, covered, mix, sliding_min, split_words

WINDOW, ANCHOR = 20, 8
NO_ID = (1 << 63) - 1
# names no input column has
KEY, SPANS = "_llm_key", "_llm_spans"


def _key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))


def _windows(words, window: int) -> np.ndarray:
    """The starts of all windows that lie in one text."""
    return np.flatnonzero(np.arange(len(words.start)) + window <= words.last())


def blocks(words, window: int = WINDOW, anchor: int = ANCHOR):
    """Anchor, words hash, first word and number of windows of each block."""
    items, starts = words.hashes(), _windows(words, window)
    if not len(starts):
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    runs = Runs(items)
    grams = runs.all(anchor)
    picked = sliding_min(grams, window - anchor + 1)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (picked[1:] != picked[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(starts)))
    first = starts[at]
    return grams[picked[at]], runs.of(first, first + count - 1 + window), first, count


def _emit_blocks(batches):
    for batch in batches:
        for piece in pieces(batch, TEXT):
            words = split_words(piece.column(TEXT))
            anchor, block, first, count = blocks(words)
            text = np.searchsorted(words.first, first, side="right") - 1
            # later blocks of the same words in the same text are that text's own matter
            same = mix(anchor ^ mix(block + np.uint64(1))) ^ mix(text.astype(np.uint64) + np.uint64(7))
            _, one = np.unique(same, return_index=True)
            ids = piece.column("key").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[text[one]]),
                    pa.array(anchor[one].view(np.int64)),
                    pa.array(block[one].view(np.int64)),
                    pa.array((first - words.first[text])[one].astype(np.int32)),
                    pa.array(count[one].astype(np.int32)),
                ],
                names=["key", "anchor", "block", "first", "count"],
            )


def _emit_windows(batches):
    """Windows of the blocks in ``spans``, if the words there are the block's."""
    for batch in batches:
        for piece in pieces(batch, TEXT):
            words = split_words(piece.column(TEXT))
            runs, n_words = Runs(words.hashes()), words.counts
            row, first, count, check, anchor = _spans(piece.column("spans"))
            fits = first + count + WINDOW - 1 <= n_words[row]
            row, first, count, check, anchor = (x[fits] for x in (row, first, count, check, anchor))
            at = words.first[row] + first
            fits = runs.of(at, at + count + WINDOW - 1).view(np.int64) == check
            row, at, count, anchor = (x[fits] for x in (row, at, count, anchor))
            which = np.repeat(np.arange(len(row)), count)
            step = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            window = at[which] + step
            row = row[which]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(piece.column("key").to_numpy()[row]),
                    pa.array(anchor[which]),
                    pa.array(runs.of(window, window + WINDOW).view(np.int64)),
                    pa.array((window - words.first[row]).astype(np.int32)),
                    pa.array(np.ones(len(row), np.int32)),
                ],
                names=["key", "anchor", "block", "first", "count"],
            )


BLOCKS = "key long, anchor long, block long, first int, count int"


def _spans(column: pa.Array):
    """Row number and fields of all structs in a column of lists; null is an empty list."""
    offsets = column.offsets.to_numpy().astype(np.int64)
    flat = column.values.slice(offsets[0], offsets[-1] - offsets[0])
    lengths = np.diff(offsets)
    if column.null_count and len(flat):
        gone = column.is_null().to_numpy(zero_copy_only=False)
        assert not lengths[gone].any()
    row = np.repeat(np.arange(len(column)), lengths)
    fields = [flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(flat.type.num_fields)]
    return row, *fields


def _by_text(rows: DataFrame, *names: str) -> DataFrame:
    """The spans of each text in one array; a text has no more than its words."""
    return rows.groupBy("key").agg(F.collect_list(F.struct(*names)).alias("spans"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans whose windows all start in a smaller id too: key, first, count (of windows), block (check)."""
    texts = docs.select(_key(id_col).alias("key"), F.col(text_col).alias(TEXT))
    found = texts.mapInArrow(_emit_blocks, BLOCKS)

    anchors = (
        found.groupBy("anchor")
        .agg(F.count("*").alias("n"), F.min("block").alias("low"), F.max("block").alias("high"), F.min("key").alias("earliest"))
        .where("n > 1")
        .select("anchor", (F.col("low") == F.col("high")).alias("alike"), "earliest")
    )
    # aggregates are written before they are joined: a join of plain shuffles is what Spark can split at a hot key
    anchors = stored(anchors, "anchors")
    seeds = stored(found.join(anchors, "anchor"), "seeds")
    alike = seeds.where("alike and key > earliest").select("key", "first", "count", "block")

    mixed = seeds.where("not alike").select("key", "anchor", "block", "first", "count")
    firsts = stored(mixed.groupBy("anchor", "block").agg(F.min("key").alias("earliest")), "firsts")
    classed = stored(mixed.join(firsts, ["anchor", "block"]), "classes")
    later = classed.where("key > earliest").select("key", "first", "count", "block")

    heads = classed.where("key = earliest")
    to_split = _by_text(heads, "first", "count", "block", "anchor")
    windows = stored(texts.join(to_split, "key").mapInArrow(_emit_windows, BLOCKS), "windows")
    single_firsts = stored(windows.groupBy("anchor", "block").agg(F.min("key").alias("earliest")), "window-firsts")
    single = windows.join(single_firsts, ["anchor", "block"]).where("key > earliest").select("key", "first", "count", "block")

    spans = stored(_by_text(alike.unionByName(later).unionByName(single), "first", "count", "block"), "spans")
    discard(anchors, seeds, firsts, classed, windows, single_firsts)
    return spans


def _marked(words, spans) -> np.ndarray:
    """Which words of a piece are to be removed."""
    runs, n = Runs(words.hashes()), len(words.start)
    row, first, count, check = spans
    fits = first + count + WINDOW - 1 <= words.counts[row]
    row, first, count, check = (x[fits] for x in (row, first, count, check))
    at = words.first[row] + first
    fits = runs.of(at, at + count + WINDOW - 1).view(np.int64) == check
    at, length = at[fits], count[fits] + WINDOW - 1

    starts = _windows(words, WINDOW)  # windows that repeat an earlier one of their own text
    text = np.searchsorted(words.first, starts, side="right") - 1
    keys = runs.of(starts, starts + WINDOW) ^ mix(text.astype(np.uint64) + np.uint64(11))
    order = np.argsort(keys, kind="stable")
    again = np.zeros(len(starts), bool)
    again[order[1:]] = keys[order[1:]] == keys[order[:-1]]
    own = starts[again]
    return covered(n, np.concatenate([at, own]), np.concatenate([length, np.full(len(own), WINDOW)]))


def _cut():
    def work(piece: pa.RecordBatch):
        words = split_words(piece.column(TEXT))
        gone = _marked(words, _spans(piece.column(SPANS)))
        kept, spans = [], []
        for i in range(piece.num_rows):
            low, high = words.first[i], words.first[i + 1]
            own, mark = words.data[words.texts[i] : words.texts[i + 1]].tobytes().split(), gone[low:high]
            if mark.any():
                own = [w for w, m in zip(own, mark.tolist(), strict=True) if not m]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], mark, [False]]).astype(np.int8)))
                spans.append([{"first": int(a), "words": int(b - a)} for a, b in edge.reshape(-1, 2)])
            else:
                spans.append([])
            kept.append(b" ".join(own).decode())
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) * (words.counts > 0)
        return (
            pa.array(words.counts.astype(np.int64)),
            pa.array(removed.astype(np.int64)),
            strings(kept),
            pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32())]))),
        )

    return work


FIELDS = [
    StructField("n_words", LongType()),
    StructField("n_removed", LongType()),
    StructField("kept_text", StringType()),
    StructField(
        "removed_spans",
        ArrayType(StructType([StructField("first", IntegerType()), StructField("words", IntegerType())])),
    ),
]


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed, kept_text (the words left, joined by a space) and
    removed_spans (maximal runs of removed words)."""
    spans = repeated_spans(docs, id_col, text_col).withColumnsRenamed({"key": KEY, "spans": SPANS})
    joined = (
        docs.withColumn(KEY, _key(id_col))
        .join(spans, KEY, "left")
        .withColumn(SPANS, F.coalesce(SPANS, F.array().cast(spans.schema[SPANS].dataType)))
    )
    return append_columns(joined, text_col, FIELDS, _cut, drop=[KEY, SPANS])
