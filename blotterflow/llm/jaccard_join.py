"""N-gram Jaccard join: texts whose sets of word shingles overlap by ``PERCENT`` or more.

Two such sets share one of their rarest shingles. So each set is ordered, rare shingles
first, by the counts of all shingles of the corpus (in ``BUCKETS`` hashed counters; any order
that all sets keep is right, and counts make it a good one), and only its prefix takes part
in the join: a posting for each shingle of the first n - ceil(0.85 n) + 1. Equal sets are one
class with one set of postings, whatever number of texts have it.

*Filters.* Two classes that meet at a shingle are a candidate if their sizes are near enough
(length); if what can still follow their places in both orders is enough (position); and if
the shingles that only one of them has are few enough (suffix): shingles are dealt to
``SKETCH`` parts by hash, and each part where the two counts differ by an odd number costs at
least one such shingle. Each of the three only leaves out pairs that can't be linked.

*No hot group is paired with itself.* In the first round each class meets two classes of each
of its shingles only, the one with the least key and the one with the largest, and is
compared with the ``STARS`` it meets most often. Their links, verified, are
joined into components. The second round looks at all other pairs, but only across
components: within the postings of a shingle the largest component isn't paired
with itself, and shingles of one component are left out. A pair of one component needs no
link of its own, so components come out as from all pairs.

*Verification.* Candidates of all shingles are made distinct, pass the suffix filter once more
with ``FINE`` parts, then are compared once, by the intersection of their whole sets, which are made again from the texts for the classes in
question. Classes that share several shingles mostly share them in a row: a pair is left
out where both have the same one before. Shingles and sets are known by hashes of 64 bits.

Cases: texts without words, null too, have the empty set and are linked with nothing; their
component is their own id. A text of fewer words than a shingle has one shingle, all of it. A null id
is never the least of its component, unless the component has no id. Rows with the same id
are texts of their own. An empty table gives no rows. Other columns of the input are left out.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from blotterflow.llm.batches import TEXT, pieces
from blotterflow.llm.components import components
from blotterflow.llm.marks import marks, passing
from blotterflow.llm.tables import discard, stored
from blotterflow.llm.words import FOLD, Runs, mix, split_words

SHINGLE, PERCENT = 4, 85
BUCKET_BITS = 18
BUCKETS = 1 << BUCKET_BITS
#: Parts of the suffix filter, 64 in a column.
SKETCH = 512
SKETCHES = [f"s{i}" for i in range(SKETCH // 64)]
#: Parts of the same filter as it is applied to pairs, before whole sets are moved.
FINE = 4096
#: Classes that a class is compared with in the first round; the second round finds the rest.
STARS = 2
ROWS, FINE_ROWS = 4096, 512
# names no input column has
ID = "_llm_id"


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text number and hash of the distinct shingles of each text, in this order."""
    words = split_words(column, fold=FOLD)
    items, last, n = words.hashes(), words.last(), words.counts
    runs = Runs(items)
    start = np.flatnonzero(np.arange(len(items)) + SHINGLE <= last)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    first = np.concatenate([start, words.first[short]])
    end = np.concatenate([start + SHINGLE, words.first[short + 1]])
    text = np.searchsorted(words.first, first, side="right") - 1
    hashes = runs.of(first, end)
    order = np.lexsort((hashes, text))
    text, hashes = text[order], hashes[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
    return text[new], hashes[new]


def set_keys(text: np.ndarray, hashes: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and key of each set; equal sets have equal keys."""
    n = np.bincount(text, minlength=texts)
    sums = np.zeros(texts, np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        sums[some] = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), np.searchsorted(text, some))
    return n, mix(sums + mix(n.astype(np.uint64) + np.uint64(11))).view(np.int64)


def sketches(text: np.ndarray, hashes: np.ndarray, texts: int, parts: int = SKETCH) -> np.ndarray:
    """A bit for each part: whether a set has an odd number of shingles there."""
    part = text * parts + (hashes & np.uint64(parts - 1)).astype(np.int64)
    odd = (np.bincount(part, minlength=texts * parts) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(texts, parts), axis=1, bitorder="little").view(np.int64)


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def prefix_length(n):
    return n - -(-PERCENT * n // 100) + 1


def _slices(batches, rows: int = ROWS):
    """Pieces of bounded text and of at most ``rows`` rows."""
    for batch in batches:
        for piece in pieces(batch, TEXT):
            for low in range(0, piece.num_rows, rows):
                yield piece.slice(low, rows)


def _described(kind: pa.DataType):
    """Size, key and sketch of every text's set; at last the shingles of the task in each bucket."""

    def run(batches):
        names = ["counted", ID, "n", "key", *SKETCHES]
        total = np.zeros(BUCKETS, np.int64)
        for piece in _slices(batches):
            text, hashes = shingle_sets(piece.column(TEXT))
            total += np.bincount(buckets(hashes), minlength=BUCKETS)
            n, keys = set_keys(text, hashes, piece.num_rows)
            sketch = sketches(text, hashes, piece.num_rows)
            columns = [pa.array(np.zeros(len(n), bool)), piece.column(ID), pa.array(n), pa.array(keys)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(c) for c in np.ascontiguousarray(sketch.T)], names=names)
        some = np.flatnonzero(total)
        columns = [pa.array(np.ones(len(some), bool)), pa.nulls(len(some), kind), pa.array(total[some]), pa.array(some)]
        yield pa.RecordBatch.from_arrays(columns + [pa.array(np.zeros(len(some), np.int64))] * len(SKETCHES), names=names)

    return run


def _postings(sent):
    """The prefix of every class that the task sees: its shingles, rare first."""

    def run(batches):
        counts, seen = sent.value, set()
        for piece in _slices(batches):
            text, hashes = shingle_sets(piece.column(TEXT))
            n, keys = set_keys(text, hashes, piece.num_rows)
            fresh = np.zeros(len(n), bool)
            for i, key in enumerate(keys.tolist()):
                if n[i] and key not in seen:
                    seen.add(key)
                    fresh[i] = True
            mine = fresh[text]
            text, hashes = text[mine], hashes[mine]
            order = np.lexsort((hashes, counts[buckets(hashes)], text))
            text, hashes = text[order], hashes[order]
            place = np.arange(len(text)) - np.searchsorted(text, text)
            early = place < prefix_length(n)[text]
            columns = [hashes[early].view(np.int64), keys[text[early]], place[early].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "key", "place"])

    return run


def _whole_sets(batches):
    """Key, fine sketch and all shingles of the classes that the task sees."""
    seen = set()
    for piece in _slices(batches, FINE_ROWS):
        text, hashes = shingle_sets(piece.column(TEXT))
        n, keys = set_keys(text, hashes, piece.num_rows)
        first = []
        for i, key in enumerate(keys.tolist()):
            if n[i] and key not in seen:
                seen.add(key)
                first.append(i)
        if first:
            fine = sketches(text, hashes, piece.num_rows, FINE)[first]
            own = np.isin(text, first)
            columns = [pa.array(keys[first])]
            for values, sizes in ((fine.reshape(-1), np.full(len(first), FINE // 64)), (hashes[own].view(np.int64), n[first])):
                columns.append(pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), pa.int32()), pa.array(values)))
            yield pa.RecordBatch.from_arrays(columns, names=["key", "fine", "shingles"])


def _needed(a: str, b: str) -> Column:
    """Shingles that two sets have to share."""
    return F.ceil(PERCENT * (F.col(a) + F.col(b)) / F.lit(100 + PERCENT) - F.lit(1e-9))


def _near(a: str = "a_", b: str = "b_") -> Column:
    """The length filter and the suffix filter."""
    na, nb = F.col(f"{a}n"), F.col(f"{b}n")
    length = PERCENT * F.greatest(na, nb) <= 100 * F.least(na, nb)
    odd = reduce(lambda x, y: x + y, [F.bit_count(F.col(a + s).bitwiseXOR(F.col(b + s))) for s in SKETCHES])
    return length & (odd <= na + nb - 2 * _needed(f"{a}n", f"{b}n"))


def _named(df: DataFrame, prefix: str, *kept: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c in kept else prefix + c) for c in df.columns])


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _ends(pairs: DataFrame) -> DataFrame:
    """The classes of pairs; each side is made distinct before they meet."""
    return pairs.select(F.col("a").alias("key")).distinct().union(pairs.select("b").distinct()).distinct()


def _links(pairs: DataFrame, classes: DataFrame, given: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) of classes that are linked."""
    wanted = stored(_ends(pairs).join(classes.select("key", ID), "key"), "wanted")
    texts = passing(given, ID, marks(wanted, ID))
    made = texts.mapInArrow(_whole_sets, "key long, fine array<long>, shingles array<long>")
    sets = stored(made.withColumn("row", F.monotonically_increasing_id()), "sets")
    # rows that repeat an id and a text, in several tasks, have made one set more than once
    firsts = stored(sets.groupBy("key").agg(F.min("row").alias("row")), "firsts")

    def beside(pairs: DataFrame, own: DataFrame, what: str) -> DataFrame:
        """One plan at every size: sets are large, so neither side is ever sent whole, and each set is dealt once."""
        for side in ("a", "b"):
            place = firsts.select(F.col("key").alias(side), F.col("row").alias(f"{side}_row"))
            pairs = pairs.join(place, side)
        for side, name in (("a", "x"), ("b", "y")):
            its = own.select(F.col("key").alias(side), F.col("row").alias(f"{side}_row"), F.col(what).alias(name))
            pairs = pairs.hint("merge").join(its, [side, f"{side}_row"])
        return pairs

    sized = classes.select("key", "n")
    both = pairs.join(_named(sized, "a_").withColumnRenamed("a_key", "a"), "a").join(_named(sized, "b_").withColumnRenamed("b_key", "b"), "b")
    odd = F.aggregate(F.zip_with("x", "y", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, n: s + n)
    few = odd <= F.col("a_n") + F.col("b_n") - 2 * _needed("a_n", "b_n")
    likely = stored(beside(both, sets, "fine").where(few).select("a", "b"), "likely")
    shared = F.size(F.array_intersect("x", "y"))
    moved = passing(sets, "key", marks(_ends(likely), "key"))
    counted = beside(likely, moved, "shingles").select("a", "b", (F.size("x") + F.size("y")).alias("both"), shared.alias("shared"))
    links = stored(counted.where(100 * F.col("shared") >= PERCENT * (F.col("both") - F.col("shared"))).select("a", "b"), "links")
    discard(wanted, sets)
    return links


def jaccard_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_shingles and component_id of every row of ``docs``."""
    spark = docs.sparkSession
    given = docs.select(F.col(id_col).alias(ID), F.col(text_col).alias(TEXT))
    id_field = StructField(ID, given.schema[ID].dataType)
    fields = [StructField("counted", given.select(F.lit(True)).schema[0].dataType), id_field]
    fields += [StructField(c, LongType()) for c in ("n", "key", *SKETCHES)]
    kind = given.select(ID).limit(0).toArrow().schema.field(ID).type
    described = stored(given.mapInArrow(_described(kind), StructType(fields)), "described")
    counts = np.zeros(BUCKETS, np.int64)
    for r in described.where("counted").groupBy("key").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        counts[r["key"]] = r["n"]
    sent = spark.sparkContext.broadcast(counts)
    rows = described.where("not counted").drop("counted")
    firsts = rows.where("n > 0").groupBy("key").agg(F.min(ID).alias(ID), *[F.min(c).alias(c) for c in ("n", *SKETCHES)])
    classes = stored(firsts, "classes")

    posting = StructType([StructField("token", LongType()), StructField("key", LongType()), StructField("place", IntegerType())])
    postings = stored(given.mapInArrow(_postings(sent), posting), "postings")
    ends = postings.groupBy("token").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high")
    tokens = stored(ends, "tokens")
    few = passing(postings, "token", marks(tokens, "token"))
    # copies in other tasks have made the same postings
    hits = stored(few.hint("merge").join(tokens, "token").distinct(), "hits")
    discard(postings)

    # first round: every class against the ends of its shingles, those it meets most often
    sized = classes.select("key", "n", *SKETCHES)
    meetings = hits.select(F.col("key").alias("a"), F.explode(F.array("low", "high")).alias("b")).where("a <> b").groupBy("a", "b").count()
    met = meetings.join(_named(sized, "a_").withColumnRenamed("a_key", "a"), "a").join(_named(sized, "b_").withColumnRenamed("b_key", "b"), "b")
    order = Window.partitionBy("a").orderBy(F.desc("count"), "b")
    starred = met.where(_near()).select("a", "b", F.row_number().over(order).alias("place")).where(F.col("place") <= STARS)
    first = _links(stored(_pairs(starred), "starred"), classes, given)

    # second round: all others, across the components of the first
    labels = components(first).select(F.col("node").alias("key"), F.col("component").alias("known"))
    label = F.coalesce("known", "key").alias("label")
    known = stored(hits.select("token", "key", "place").join(labels, "key", "left").select("token", "key", "place", label), "labelled")
    by_label = known.groupBy("token", "label").count()
    largest = by_label.groupBy("token").agg(F.max(F.struct("count", "label")).alias("most"), F.count("*").alias("labels"))
    mixed = stored(largest.where("labels > 1").select("token", F.col("most.label").alias("main")), "mixed")
    before = F.lag("token").over(Window.partitionBy("key").orderBy("place"))
    rows = stored(known.join(mixed, "token").withColumn("before", before).join(sized, "key"), "across")
    left = _named(rows.where("label <> main").drop("main"), "a_", "token")
    right = _named(rows.drop("main"), "b_", "token")
    room = F.least(F.col("a_n") - F.col("a_place"), F.col("b_n") - F.col("b_place"))
    # two classes with the same shingle before this one have met there, with more room still
    new = ~F.coalesce(F.col("a_before") == F.col("b_before"), F.lit(False))
    across = left.join(right, "token").where((F.col("a_label") != F.col("b_label")) & new & (room >= _needed("a_n", "b_n")) & _near())
    second = _links(stored(_pairs(across.select(F.col("a_key").alias("a"), F.col("b_key").alias("b"))), "pairs"), classes, given)

    linked = components(first.unionByName(second)).select(F.col("node").alias("key"), "component")
    grouped = stored(classes.select("key", ID).join(linked, "key", "left").withColumn("component", F.coalesce("component", "key")), "grouped")
    least = stored(grouped.groupBy("component").agg(F.min(ID).alias("component_id")), "least")
    named = stored(grouped.join(least, "component").select("key", "component_id"), "named")
    out = described.where("not counted").join(named, "key", "left").select(
        F.col(ID).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col(ID)).alias("component_id"),
    )
    discard(tokens, hits, known, mixed, rows, grouped, least)
    return out
