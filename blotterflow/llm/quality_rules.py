"""Quality rules: counts of a text, and the log-likelihood ratio of two n-gram models.

Words and word pairs are hashed into ``BUCKETS``. Two multinomials over the buckets
are counted: one of trusted texts, one of the whole corpus. A text's score is the mean,
over its n-grams, of log(trusted / corpus): its length cancels out. Every text is judged
by the same threshold, without chance: the score that all but ``STRAY`` of the trusted
texts reach, found exactly by counting, whatever the partitions. A text that fails a base rule is not
kept whatever it scores.

The corpus model counts every text, the trusted model every trusted one, and the threshold
comes from the scores of all of these. Texts are joined to the trusted ids by a shuffle, after a filter
of bounded size has left out most others. Counts are summed in each task first: a task sends
one row for each bucket.

Cases: null and empty texts have no words, fail the base rules and score 0. Rows with
the same id are trusted together; a null id never is. Without trusted texts the base
rules alone decide. Repeated rows count as often as they stand. An empty table gives no
rows. Columns of the input with the names of the output are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from blotterflow.llm.batches import TEXT, append_columns, pieces
from blotterflow.llm.marks import marks, passing
from blotterflow.llm.tables import discard, stored
from blotterflow.llm.words import NOT_BLANK, Runs, byte_class, covered, mix, split_words

BUCKETS = 10_000
STRAY, PRIOR = 0.005, 2.0
#: Widths of the steps that scores are counted in; a score is a mean of log ratios, some tens at most.
STEPS = (1e-3, 1e-6, 1e-9)
REPEAT = 5
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20
SYMBOL = byte_class(*[(ord(c), ord(c)) for c in "#*$%&|<>"])

ID = "_llm_id"
FIELDS = [StructField(n, LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
FIELDS += [StructField("base_failed", BooleanType()), StructField("score", DoubleType()), StructField("kept", BooleanType())]


def _sums(flags: np.ndarray, starts: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` over segments; ``some``: which segments aren't empty."""
    return np.add.reduceat(np.append(flags, 0).astype(np.int64), starts) * some


def again(keys: np.ndarray, first_too: bool) -> np.ndarray:
    """Which keys stand more than once, with or without their first place."""
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(keys) + 1, bool)
    same[1:-1] = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order] = same[:-1] | same[1:] if first_too else same[:-1]
    return out


def grams(words):
    """Bucket and text number of every word and word pair."""
    items, text = words.hashes(), words.text_of()
    pairs = Runs(items).all(2)[: max(len(items) - 1, 0)]
    inside = text[1:] == text[:-1]
    buckets = np.concatenate([mix(items), pairs[inside]]) % np.uint64(BUCKETS)
    return buckets.astype(np.int64), np.concatenate([text, text[:-1][inside]])


def base_counts(words):
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    data, texts, n = words.data, words.texts, words.counts
    some = np.diff(texts) > 0
    chars = _sums(NOT_BLANK[data] & ((data & 0xC0) != 0x80), texts[:-1], some)
    symbols = _sums(SYMBOL[data], texts[:-1], some)

    items, last = words.hashes(), words.last()
    starts = np.flatnonzero(np.arange(len(items)) + REPEAT <= last)
    own = mix(words.text_of()[starts].astype(np.uint64) + np.uint64(3))
    runs = Runs(items).of(starts, starts + REPEAT)
    hit = covered(len(items), starts[again(runs ^ own, True)], REPEAT)
    repeated = _sums(hit, words.first[:-1], n > 0)

    # lines: from a text's start or a line feed to the next; only those with a word
    feeds = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.concatenate([texts[:-1][some], feeds + 1]))
    begin = begin[begin < len(data)]
    line_text = np.searchsorted(texts, begin, side="right") - 1
    end = np.append(begin[1:], len(data))
    end = np.where(np.isin(end - 1, feeds), end - 1, end)
    full = np.searchsorted(words.start, end) > np.searchsorted(words.start, begin)
    begin, end, line_text = begin[full], end[full], line_text[full]
    keys = Runs(data.astype(np.uint64) + np.uint64(1)).of(begin, end) ^ mix(line_text.astype(np.uint64) + np.uint64(5))
    lines = np.bincount(line_text[again(keys, False)], minlength=len(n))
    return n, chars, symbols, lines, repeated


@dataclass
class Ratio:
    """The log ratio of each bucket, and the threshold."""

    weights: np.ndarray
    threshold: float

    def scores(self, words) -> np.ndarray:
        buckets, text = grams(words)
        n = len(words.counts)
        total = np.bincount(text, self.weights[buckets], minlength=n)
        return total / np.maximum(np.bincount(text, minlength=n), 1)


def _count_grams(batches):
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for piece in pieces(batch, TEXT):
            total += np.bincount(grams(split_words(piece.column(TEXT)))[0], minlength=BUCKETS)
    if total.any():
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS, dtype=np.int32)), pa.array(total)], names=["bucket", "n"])


def _gram_counts(texts: DataFrame) -> np.ndarray:
    counted = texts.mapInArrow(_count_grams, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(BUCKETS)
    for r in counted.collect():
        total[r.bucket] = r.n
    return total


def low_score(scored: DataFrame, share: float) -> float:
    """The least score, but for a ``share`` of the rows: exact, and the same in any order.

    Scores are counted in steps of ``STEPS[0]``, then those of the step in question in smaller ones;
    of the last step, the scores themselves are counted.
    """
    here, rank, low = scored.select("score"), None, 0.0
    for step in STEPS:
        bins = here.groupBy(F.floor((F.col("score") - low) / step).alias("bin")).agg(F.count("*").alias("n"))
        counts = sorted((r.bin, r.n) for r in bins.collect())
        rank = math.floor(share * sum(n for _, n in counts)) if rank is None else rank
        at, rank = _find(counts, rank)
        here = here.where(F.floor((F.col("score") - low) / step) == at)
        low += at * step
    values = sorted((r.score, r.n) for r in here.groupBy("score").agg(F.count("*").alias("n")).collect())
    return _find(values, rank)[0]


def _find(counts: list[tuple], rank: int) -> tuple:
    """The key that holds the ``rank``-th row, and the row's rank among its own."""
    for key, n in counts:
        if rank < n:
            return key, rank
        rank -= n
    raise ValueError("no such rank")


def fit(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Ratio | None:
    """``trusted`` has the ids of trusted texts. None if no text is."""
    spark = docs.sparkSession
    # written first: a join of plain shuffles is what Spark can split at a hot key
    ids = stored(trusted.select(F.col(id_col).alias(ID)).where(F.col(ID).isNotNull()).distinct(), "trusted-ids")
    given = docs.select(F.col(id_col).alias(ID), F.col(text_col).alias(TEXT))
    # one plan at every size: texts that may be trusted are shuffled, others stay where they are
    known = passing(given.where(F.col(ID).isNotNull()), ID, marks(ids, ID))
    own = _gram_counts(known.hint("merge").join(ids, ID, "left_semi").select(TEXT))
    if not own.any():
        return None
    total = _gram_counts(given.select(TEXT)), own
    # trusted counts against those the corpus lets expect; where few are, both are drawn together
    expected = total[0] * (total[1].sum() / total[0].sum())
    ratio = Ratio(np.log((total[1] + PRIOR) / (expected + PRIOR)), 0.0)
    sent = spark.sparkContext.broadcast(ratio)

    def score(batches):
        for batch in batches:
            for piece in pieces(batch, TEXT):
                scores = pa.array(sent.value.scores(split_words(piece.column(TEXT))))
                yield pa.RecordBatch.from_arrays([piece.column(ID), scores], names=[ID, "score"])

    # scored before they are joined, as ids and scores are shuffled for less than texts are
    scored = known.mapInArrow(score, StructType([known.schema[ID], StructField("score", DoubleType())]))
    scored = stored(scored.hint("merge").join(ids, ID, "left_semi"), "scored")
    low = low_score(scored, STRAY)
    discard(ids, scored)
    return Ratio(ratio.weights, low)


def judge(docs: DataFrame, ratio: Ratio | None, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts, base_failed, score and kept."""
    sent = docs.sparkSession.sparkContext.broadcast(ratio)

    def build():
        ratio = sent.value

        def work(piece: pa.RecordBatch):
            words = split_words(piece.column(TEXT))
            counts = base_counts(words)
            failed = (counts[0] < MIN_WORDS) | (100 * counts[4] > MAX_REPEATED_PERCENT * counts[0])
            scores = np.zeros(len(failed)) if ratio is None else ratio.scores(words)
            kept = ~failed if ratio is None else ~failed & (scores >= ratio.threshold)
            return [pa.array(c.astype(np.int64)) for c in counts] + [pa.array(failed), pa.array(scores), pa.array(kept)]

        return work

    return append_columns(docs, text_col, FIELDS, build)


def quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fits on ``docs`` and the ids in ``trusted``, and judges every text of ``docs``."""
    return judge(docs, fit(docs, trusted, id_col, text_col), text_col)
