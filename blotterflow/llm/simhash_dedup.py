"""SimHash near-dedup with a Gray-order hierarchical index.

Fingerprints that differ in at most ``LIMIT`` of 64 bits agree in one of ``LIMIT`` + 1
fixed blocks of bits. So each distinct fingerprint is turned once for each block, the
block in front, and each turn is sorted by Gray rank across the cluster. Values with
one front block are neighbours then: the block is the bits they share at the top of the
hierarchy, and ``gray_index`` finds the links under it. Sorted partitions are read in
pages of bounded size; the values of a block that spans pages are compared page with
page, where the bits the two pages share allow a link at all.

A page gives one link for each member of a linked set, never all its pairs; links are
joined into components afterwards. Equal texts are one fingerprint, so a group of
copies of any size is one row in all of this.

Cases: a text without words, null too, has fingerprint zero and is linked like any
other. A null id is never the least of its component, unless the component has no id.
Repeated rows get equal results. An empty table gives no rows. Columns of the input
with the names of the output are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField
from xxhash import xxh64_intdigest

from blotterflow.llm.batches import TEXT, append_columns, text_bytes
from blotterflow.llm.components import components
from blotterflow.llm.gray_index import cross_roots, gray_rank, rotate, self_roots, shared
from blotterflow.llm.tables import discard, stored
from blotterflow.llm.words import FOLD

SHINGLE, SEED, LIMIT = 4, 42, 4
TURNS = LIMIT + 1
WIDTHS = [64 // TURNS + (i < 64 % TURNS) for i in range(TURNS)]
PAGE = 1 << 16


def fingerprint(text: bytes) -> int:
    """The SimHash of a text's word shingles; A-Z are folded by the caller."""
    words = text.split()
    n = len(words) - SHINGLE + 1
    if not words:
        return 0
    if n <= 1:
        return xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    begins = np.concatenate([[0], ends[: n - 1]]).tolist()
    stops = (ends[SHINGLE - 1 :] - 1).tolist()
    hashes = np.fromiter([xxh64_intdigest(joined[a:b], SEED) for a, b in zip(begins, stops, strict=True)], ">u8", n)
    ones = np.zeros(64, np.int64)
    for low in range(0, n, 1 << 12):
        part = hashes[low : low + (1 << 12)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _fingerprints():
    def work(piece: pa.RecordBatch):
        data, places = text_bytes(piece.column(TEXT))
        folded = FOLD[data].tobytes()
        places = places.tolist()
        values = [fingerprint(folded[a:b]) for a, b in zip(places, places[1:])]
        return (pa.array(np.array(values, np.uint64).view(np.int64)),)

    return work


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the fingerprint as a signed 64-bit ``bits``."""
    return append_columns(docs, text_col, [StructField("bits", LongType())], _fingerprints)


def _turn(batches):
    """Each fingerprint in every turn, with the Gray rank of the turned value (ordered as signed)."""
    for batch in batches:
        bits = batch.column("bits").to_numpy().view(np.uint64)
        for turn in range(TURNS):
            rank = gray_rank(rotate(bits, sum(WIDTHS[:turn])))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(bits), turn, np.int32)), pa.array((rank ^ np.uint64(1 << 63)).view(np.int64))],
                names=["turn", "rank"],
            )


PAGES = "a long, b long, turn int, front long, page long, mask long, pattern long, members binary"
_EMPTY = np.zeros(0, np.int64)


def _rows(links=(_EMPTY, _EMPTY), ends=()):
    """A batch of links and of page ends: (turn, front, page, mask, pattern, members)."""
    n, m = len(links[0]), len(ends)
    columns = [pa.concat_arrays([pa.array(x, pa.int64()), pa.nulls(m, pa.int64())]) for x in links]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    for i, kind in enumerate(kinds):
        columns.append(pa.concat_arrays([pa.nulls(n, kind), pa.array([e[i] for e in ends], kind)]))
    return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in PAGES.split(", ")])


def _links(values: np.ndarray, root: np.ndarray):
    tied = np.flatnonzero(root != np.arange(len(root)))
    return values[tied].view(np.int64), values[root[tied]].view(np.int64)


def _page(turn: np.ndarray, rank: np.ndarray, number: int):
    rank = rank.view(np.uint64) ^ np.uint64(1 << 63)
    turned = rank ^ (rank >> np.uint64(1))
    width = np.array(WIDTHS)[turn].astype(np.uint64)
    front = (turned >> (np.uint64(64) - width)).astype(np.int64)
    new = np.ones(len(rank), bool)
    new[1:] = (turn[1:] != turn[:-1]) | (front[1:] != front[:-1])
    starts = np.flatnonzero(new)
    root = self_roots(turned, starts, LIMIT)
    ends = []
    for g in sorted({0, len(starts) - 1}):  # the groups that may go on in other pages
        low, high = starts[g], starts[g + 1] if g + 1 < len(starts) else len(rank)
        mask, pattern = shared(turned[low:high], np.zeros(1, np.int64))
        ends.append(
            (int(turn[low]), int(front[low]), number, int(mask.view(np.int64)[0]), int(pattern.view(np.int64)[0]), turned[low:high].tobytes())
        )
    back = np.empty_like(turned)
    for t in range(TURNS):
        own = turn == t
        back[own] = rotate(turned[own], 64 - sum(WIDTHS[:t]))
    return _rows(_links(back, root), ends)


def _page_reader(size: int):
    def read(batches):
        from pyspark import TaskContext

        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        turns, ranks, have = [], [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                take = batch.slice(at, min(size - have, batch.num_rows - at))
                turns.append(take.column("turn").to_numpy())
                ranks.append(take.column("rank").to_numpy())
                have, at = have + take.num_rows, at + take.num_rows
                if have == size:
                    yield _page(np.concatenate(turns), np.concatenate(ranks), number)
                    turns, ranks, have, number = [], [], 0, number + 1
        if have:
            yield _page(np.concatenate(turns), np.concatenate(ranks), number)

    return read


def _read_page_pairs(batches):
    for batch in batches:
        for row in batch.to_pylist():
            left, right = (np.frombuffer(row[x], np.uint64) for x in ("members", "others"))
            back = rotate(np.concatenate([left, right]), 64 - sum(WIDTHS[: row["turn"]]))
            a, b = _links(back, cross_roots(left, right, LIMIT))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def fingerprint_links(distinct: DataFrame, page: int = PAGE) -> DataFrame:
    """Links (a, b) that join all fingerprints of ``distinct(bits)`` within ``LIMIT`` bits, directly or by others."""
    turned = distinct.select("bits").mapInArrow(_turn, "turn int, rank long")
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = turned.repartitionByRange(n, "turn", "rank").sortWithinPartitions("turn", "rank")
    pages = stored(ordered.mapInArrow(_page_reader(page), PAGES), "pages")
    ends = pages.where("members is not null")
    others = ends.select("turn", "front", F.col("page").alias("page2"), F.col("mask").alias("mask2"), F.col("pattern").alias("pattern2"), F.col("members").alias("others"))
    differ = F.bit_count(F.col("pattern").bitwiseXOR(F.col("pattern2")).bitwiseAND(F.col("mask")).bitwiseAND(F.col("mask2")))
    pairs = ends.join(others, ["turn", "front"]).where((F.col("page") < F.col("page2")) & (differ <= LIMIT))
    across = pairs.select("turn", "members", "others").mapInArrow(_read_page_pairs, "a long, b long")
    return pages.where("a is not null").select("a", "b").unionByName(across)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, fingerprint (16 hexadecimal digits) and component_id of every row of ``docs``."""
    given = docs.select(F.col(id_col), F.col(text_col).alias(TEXT))
    marks = append_columns(given, TEXT, [StructField("bits", LongType())], _fingerprints, drop=[TEXT])
    marks = stored(marks, "fingerprints")
    distinct = stored(marks.groupBy("bits").agg(F.min(id_col).alias("least")), "distinct")
    linked = components(fingerprint_links(distinct))
    of = distinct.join(linked.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "least", F.coalesce("component", "bits").alias("component")
    )
    least = of.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of.join(least, "component").select("bits", "component_id")
    return marks.join(named, "bits").select(
        id_col, F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the least id of each component; of rows that repeat this id, any one.

    Rows without an id stay, as no other can be named in their place.
    """
    heads = near_duplicates(docs, id_col, text_col).where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    kept = docs.join(heads, id_col, "left_semi").dropDuplicates([id_col])
    return kept.unionByName(docs.where(F.col(id_col).isNull()))
