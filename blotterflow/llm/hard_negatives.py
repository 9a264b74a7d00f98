"""Hard negatives of anchor vectors, by Kronecker-packed integer products.

Vectors become whole numbers, floor(``SCALE`` * x). Several candidates are packed into
each wide integer: every component is biased to at least zero and put into a field of
its own, so one product with an anchor's component multiplies all of them, and the sum
over the components holds one score per field. Fields are as wide as the largest possible
sum, which is worked out from the data, so none runs over and unpacked scores are exact.

Candidates are sorted by label and id over the cluster and stored in pages; anchors are
stored in blocks. Every block meets every page of every partition in a join on the
partition's number. The pages of a partition follow one another for a block, so a task
keeps only the best rows of the block at hand and sends those on; the last choice is a
ranking of these few. The first round looks at pages with a block's labels only and finds
the positives, the second looks for negatives between the two bounds of each positive.

Cases: rows with a null label, a null vector, or a null, NaN or infinite component take
no part. Vectors of unequal length: the shorter is filled up with zeros, so an empty
vector scores 0 everywhere. Components beyond ``LIMIT`` count as ``LIMIT``; scores beyond
64 bits count as the largest that fit. Rows without an id come last among equal scores,
are never anchors, and have a null id in the result. Rows that repeat an id or all of a row are
rows of their own: each is an anchor, and a copy is another row to it. An empty table, and
one without anchors, gives no rows. Other columns of the input are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotterflow.llm.tables import discard, stored

SCALE, LIMIT = 256, 1 << 26
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 50, 95
PAGE_ROWS, BLOCK_ROWS, PAGE_VALUES = 4096, 1024, 1 << 19
NO_ID = (1 << 63) - 1
LEAST = -(1 << 63)

PAGE = "part long, page long, low long, high long, dims int, ids binary, labels binary, rows binary, values binary"
BLOCK = PAGE + ", positive_ids binary, positive_scores binary"


@dataclass(frozen=True)
class Fields:
    """How candidates are packed: ``bias`` makes components positive, a field has ``width`` bits."""

    bias: int
    width: int

    @property
    def count(self) -> int:
        return max(64 // self.width, 1) if self.width <= 64 else 8

    @property
    def kind(self):
        return np.uint64 if self.width <= 64 else object

    def word(self, value: int) -> int:
        """``value`` in each field."""
        return sum(value << (self.width * i) for i in range(self.count))

    def pack(self, values: np.ndarray) -> np.ndarray:
        """One column of words for ``count`` rows of ``values``; the rows of a field lie together."""
        n, dims = values.shape
        each = -(-n // self.count)
        biased = np.zeros((each * self.count, dims), np.int64)
        biased[:n] = values
        biased += self.bias
        words = np.zeros((dims, each), self.kind)
        for i in range(self.count):
            field = biased[i * each : (i + 1) * each].T.astype(self.kind)
            words += field << self.kind(self.width * i) if self.kind is np.uint64 else field << self.width * i
        return words

    def scores(self, anchors: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        """The inner products of ``anchors`` with the ``n`` packed rows."""
        dims = min(anchors.shape[1], len(words))
        half = 1 << (self.width - 1)
        taken = self.bias * anchors[:, :dims].sum(axis=1, dtype=np.int64)[:, None] if self.kind is np.uint64 else None
        each = words.shape[1]
        out = np.empty((len(anchors), each * self.count), np.int64)
        if self.kind is np.uint64:
            sums = anchors[:, :dims].astype(np.int64).view(np.uint64) @ words[:dims]
            sums += np.uint64(self.word(half) & ((1 << 64) - 1))
            mask = np.uint64((1 << self.width) - 1)
            for i in range(self.count):
                field = (sums >> np.uint64(self.width * i)) & mask
                out[:, i * each : (i + 1) * each] = (field - np.uint64(half)).view(np.int64) - taken
            return out[:, :n]
        sums = anchors[:, :dims].astype(object) @ words[:dims] + self.word(half)
        taken = self.bias * anchors[:, :dims].astype(object).sum(axis=1)[:, None]
        for i in range(self.count):
            field = ((sums >> self.width * i) & ((1 << self.width) - 1)) - half - taken
            out[:, i * each : (i + 1) * each] = np.clip(field, LEAST, NO_ID).astype(np.int64)
        return out[:, :n]


def fields(least: int, most: int, length: int) -> Fields:
    """Fields for components from ``least`` to ``most`` and anchors whose absolute components sum up to ``length``."""
    least, most = min(least, 0), max(most, 0)
    return Fields(-least, (length * (most - least)).bit_length() + 1)


@dataclass
class Page:
    """Vectors that lie together, as read from a row of pages or blocks."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    values: np.ndarray

    @classmethod
    def read(cls, row: dict, to: str = "") -> Page:
        ids, labels, rows = (np.frombuffer(row[to + c], np.int64) for c in ("ids", "labels", "rows"))
        return cls(ids, labels, rows, np.frombuffer(row[to + "values"], np.int32).reshape(len(ids), row[to + "dims"]))

    def by_id(self) -> Page:
        order = np.lexsort((self.rows, self.ids))
        return Page(self.ids[order], self.labels[order], self.rows[order], self.values[order])


def _filled(values: list[np.ndarray], dims: int) -> np.ndarray:
    out = np.zeros((len(values), dims), np.int32)
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def _pager(most: int, extra: tuple[str, ...] = ()):
    """Rows in pages of at most ``most`` rows and ``PAGE_VALUES`` components, or one row."""

    def pages(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context = TaskContext.get()
        part, number, held, dims = context.partitionId() if context else 0, 0, [], 0
        names = [c.split()[0] for c in (BLOCK if extra else PAGE).split(", ")]

        def page():
            ids, labels, rows, values, *more = zip(*held, strict=True)
            columns = [np.array(c, np.int64) for c in (ids, labels, rows)]
            binary = [c.tobytes() for c in columns] + [_filled(values, dims).tobytes()]
            for c in more:  # the positives of anchors, as lists of at most POSITIVES
                full = np.full((len(held), POSITIVES), LEAST, np.int64)
                for i, v in enumerate(c):
                    full[i, : len(v)] = v
                binary.append(full.tobytes())
            first = [part, (part << 32) + number, int(columns[1].min()), int(columns[1].max()), dims]
            return pa.RecordBatch.from_pylist([dict(zip(names, first + binary, strict=True))], schema=SCHEMAS[bool(extra)])

        for batch in batches:
            given = [batch.column(c).to_pylist() for c in ("id", "label", "row")]
            values = batch.column("values")
            flat, ends = np.asarray(values.flatten()), np.concatenate([[0], np.cumsum(np.asarray(values.value_lengths()))])
            vectors = [flat[a:b] for a, b in zip(ends, ends[1:])]
            for row in zip(*given, vectors, *[batch.column(c).to_pylist() for c in extra], strict=True):
                wide = max(dims, len(row[3]))
                if held and (len(held) == most or (len(held) + 1) * wide > PAGE_VALUES):
                    yield page()
                    held, number, wide = [], number + 1, len(row[3])
                held.append(row)
                dims = wide
        if held:
            yield page()

    return pages


_KINDS = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
SCHEMAS = [pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in s.split(", ")]) for s in (PAGE, BLOCK)]


def _meetings(batches):
    """(block row, its page rows one by one): the block again where it changes."""
    for batch in batches:
        for row in batch.to_pylist():
            yield (row["part"], row["b_page"]), row


def _positives(packing: Fields):
    names = ["row", "positive_id", "positive_score"]

    def run(batches):
        at = block = best = None
        for key, row in _meetings(batches):
            if key != at:
                if block is not None:
                    yield _best(block, best)
                at, block, best = key, Page.read(row, "b_"), None
                best = np.full((2, len(block.ids), POSITIVES), LEAST, np.int64)  # scores and ids
                best[1] = NO_ID
            page = Page.read(row)
            for label in np.intersect1d(block.labels, page.labels):
                mine = slice(*np.searchsorted(block.labels, [label, label + 1]))
                its = slice(*np.searchsorted(page.labels, [label, label + 1]))
                ids, rows = page.ids[its], page.rows[its]
                scores = packing.scores(block.values[mine], packing.pack(page.values[its]), len(ids))
                scores[block.rows[mine][:, None] == rows] = LEAST
                found = [best[:, mine]]
                for _ in range(min(POSITIVES, len(ids))):  # ids ascend, so the first of equals has the least
                    place = scores.argmax(axis=1)
                    top = np.take_along_axis(scores, place[:, None], 1)
                    found.append(np.stack([top, np.where(top == LEAST, NO_ID, ids[place][:, None])]))
                    np.put_along_axis(scores, place[:, None], LEAST, 1)
                both = np.concatenate(found, axis=2)
                order = np.lexsort((both[1], -both[0] - 1), axis=1)[:, :POSITIVES]
                best[:, mine] = np.take_along_axis(both, order[None], 2)
        if block is not None:
            yield _best(block, best)

    def _best(block, best):
        anchor, place = np.nonzero(best[0] > LEAST)
        columns = [block.rows[anchor], best[1][anchor, place], best[0][anchor, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    return run


class Nearest:
    """The best negatives of each anchor and positive of a block so far."""

    def __init__(self, scores: np.ndarray):
        """``scores``: of the positives, ``LEAST`` where there is none."""
        some = scores > 0  # a positive of 0 or less has its bounds the wrong way round, or both at 0
        zero = scores == 0
        # 50 p <= 100 s <= 95 p, in whole numbers and without running over
        whole, rest = scores // 100, scores % 100
        self.low = np.where(some, whole * LOW - (-rest * LOW // 100), np.where(zero, 0, NO_ID))
        self.high = np.where(some, whole * HIGH + rest * HIGH // 100, np.where(zero, 0, LEAST))
        self.bound = self.low.copy()  # and not below the last of enough
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, scores: np.ndarray, other: np.ndarray, ids: np.ndarray) -> None:
        """``other``: which are of another label."""
        fit = (scores >= self.bound.min(axis=1)[:, None]) & (scores <= self.high.max(axis=1)[:, None]) & other
        anchor, place = np.nonzero(fit)
        value = scores[anchor, place]
        slots, taken, named = [self.slot], [self.score], [self.id]
        for k in range(POSITIVES):
            good = (value >= self.bound[anchor, k]) & (value <= self.high[anchor, k])
            slots.append(anchor[good] * POSITIVES + k)
            taken.append(value[good])
            named.append(ids[place[good]])
        if sum(map(len, slots)) == len(self.slot):
            return
        slot, score, name = map(np.concatenate, (slots, taken, named))
        order = np.lexsort((name, -score, slot))
        slot, score, name = slot[order], score[order], name[order]
        first = np.searchsorted(slot, slot, side="left")
        rank = np.arange(len(slot)) - first
        kept = rank < NEGATIVES
        self.slot, self.score, self.id = slot[kept], score[kept], name[kept]
        full = rank == NEGATIVES - 1
        self.bound.reshape(-1)[slot[full]] = score[full]


NEGATIVE = "row long, place int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


def _negatives(packing: Fields):
    names = [c.split()[0] for c in NEGATIVE.split(", ")]

    def rows(block, positives, best):
        anchor, place = np.divmod(best.slot, POSITIVES)
        columns = [block.rows[anchor], place.astype(np.int32), block.ids[anchor]]
        columns += [p[anchor, place] for p in positives] + [best.id, best.score]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def run(batches):
        at = block = positives = best = None
        for key, row in _meetings(batches):
            if key != at:
                if block is not None:
                    yield rows(block, positives, best)
                at, block = key, Page.read(row, "b_")
                positives = [np.frombuffer(row[f"b_positive_{c}"], np.int64).reshape(-1, POSITIVES) for c in ("ids", "scores")]
                best = Nearest(positives[1])
            page = Page.read(row)
            scores = packing.scores(block.values, packing.pack(page.values), len(page.ids))
            best.add(scores, block.labels[:, None] != page.labels, page.ids)
        if block is not None:
            yield rows(block, positives, best)

    return run


def _meet(pages: DataFrame, blocks: DataFrame, parts: int, same_label: bool) -> DataFrame:
    """Every block with every page of each partition; the same plan at every size."""
    sent = blocks.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"), *[F.col(c).alias(f"b_{c}") for c in blocks.columns if c != "part"])
    both = sent.hint("merge").join(pages, "part")
    return both.where("b_low <= high and low <= b_high") if same_label else both


def hard_negatives(vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` is the condition of anchors. Each has its ``POSITIVES`` best rows of its own
    label, and for each of these the ``NEGATIVES`` best rows of other labels whose scores
    are at least ``LOW`` and at most ``HIGH`` percent of the positive's. Best is the higher
    score, then the smaller id.
    """
    x = F.col(vector_col)
    whole = F.transform(x, lambda v: F.greatest(F.least(F.floor(F.lit(float(SCALE)) * v.cast("double")), F.lit(LIMIT)), F.lit(-LIMIT)).cast("int"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    given = vectors.where(F.col(label_col).isNotNull() & x.isNotNull() & F.coalesce(finite, F.lit(False)))
    rows = stored(
        given.select(
            F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
            F.col(label_col).cast("long").alias("label"),
            F.monotonically_increasing_id().alias("row"),
            (F.coalesce(anchor, F.lit(False)) & F.col(id_col).isNotNull()).alias("anchor"),
            whole.alias("values"),
        ),
        "vectors",
    )
    length = F.aggregate("values", F.lit(0).cast("long"), lambda a, v: a + F.abs(v))
    found = rows.agg(F.min(F.array_min("values")).alias("least"), F.max(F.array_max("values")).alias("most"), F.max(length).alias("length")).first()
    packing = fields(found.least or 0, found.most or 0, found.length or 0)

    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "label", "id", "row").sortWithinPartitions("label", "id", "row")
    pages = stored(ordered.select("id", "label", "row", "values").mapInArrow(_pager(PAGE_ROWS), PAGE), "pages")
    chosen = rows.where("anchor").repartitionByRange(parts, "label", "id", "row").sortWithinPartitions("label", "id", "row")
    blocks = stored(chosen.select("id", "label", "row", "values").mapInArrow(_pager(BLOCK_ROWS), PAGE), "anchors")

    kin = _meet(pages, blocks, parts, True).mapInArrow(_positives(packing), "row long, positive_id long, positive_score long")
    order = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    few = kin.withColumn("place", F.row_number().over(order)).where(F.col("place") <= POSITIVES)
    lists = few.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("own"))
    known = rows.where("anchor").join(stored(lists, "positives"), "row")
    known = known.select("id", "label", "row", "values", F.col("own.positive_id").alias("positive_ids"), F.col("own.positive_score").alias("positive_scores"))
    again = known.repartitionByRange(parts, "label", "id", "row").sortWithinPartitions("label", "id", "row")
    judged = stored(again.mapInArrow(_pager(BLOCK_ROWS, ("positive_ids", "positive_scores")), BLOCK), "judged")

    far = _meet(pages, judged, parts, False).mapInArrow(_negatives(packing), NEGATIVE)
    order = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    best = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
    out = stored(
        best.select("anchor_id", F.nullif("positive_id", F.lit(NO_ID)).alias("positive_id"), "rank", F.nullif("negative_id", F.lit(NO_ID)).alias("negative_id"), "positive_score", "negative_score"),
        "negatives",
    )
    discard(rows, pages, blocks, judged)
    return out
