"""Toxicity: a linear classifier regularised by counterfactuals.

A text is the set of its words and of their beginnings of 4 to 6 bytes, as insults have
many endings; the classifier adds up the weights of the set. In a labelled
sentence that names a group, the group's term is swapped for every other term of its
kind, and the squared change of the logit is a penalty (``PAIR``): the weights of
groups are drawn together, and the words around them have to explain the label. As few
sentences name a group, terms are also put into every labelled sentence: the change
from one term of a kind to the next is penalised alike (where in the sentence, makes no
difference to a set). An L1 penalty leaves weight on few words, so that the length of a
text tells nothing.

Fitting reads the words of at most ``SAMPLE`` labelled texts of each label, those with
the smallest hashes of id, then of text; so their ids can be sent to executors, and
their words, of at most ``VOCABULARY`` kinds, fit on the driver: 2 GB at worst, if every
one of these texts holds every word. Words are told apart by 64-bit hashes. Scoring is
row-local and reads whole texts.

Cases: null and empty texts have no words and get the score of the bias alone. Rows
with the same id share their label; with several labels, 1 wins. Rows held out, without
an id or without a label teach nothing; with no toxic or no clean text to learn from,
every score is 0. Repeated rows get equal results. An empty table gives no rows.
Columns of the input with the names of the output are replaced.
"""

from __future__ import annotations

import operator
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from blotterflow.llm.batches import TEXT, append_columns, pieces
from blotterflow.llm.language_id import held_out
from blotterflow.llm.tables import stored
from blotterflow.llm.words import ALNUM, FOLD, Runs, mix, split_words

#: At most so many texts of each label, and so many words, are learned from.
SAMPLE, VOCABULARY, LEAST = 4_000, 1 << 16, 4
ROUNDS, RATE, SPARSE, PAIR = 400, 0.3, 5e-4, 0.5
THRESHOLD = 0.7

#: Kinds of terms that name groups of people; terms of one kind stand for each other.
IDENTITIES = (
    ("women", "men", "girls", "boys", "frauen", "männer", "femmes", "hommes", "mujeres", "hombres"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "muslim", "christian", "jewish", "hindu"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("immigrants", "refugees", "foreigners", "locals"),
    ("old", "young", "elderly", "disabled", "blind", "deaf"),
)

FIELDS = [StructField("score", DoubleType()), StructField("predicted", IntegerType())]


BEGINNINGS = (4, 5, 6)
#: The label of a text, and the order in which texts are sampled.
KEY = ("label", "by_id", "by_text")


def features(column: pa.Array):
    """Hash and text number of every word and word beginning, and the number of texts."""
    words = split_words(column, ALNUM, FOLD)
    size, text = words.end - words.start, words.text_of()
    runs = Runs(words.data.astype(np.uint64) + np.uint64(1))
    hashes, rows = [runs.of(words.start, words.end)], [text]
    for n in BEGINNINGS:
        long = size >= n
        hashes.append(mix(runs.of(words.start[long], words.start[long] + n) + np.uint64(n)))
        rows.append(text[long])
    return np.concatenate(hashes), np.concatenate(rows), len(column)


def term_features(term: str) -> list[int]:
    """The hashes of one word and of its beginnings."""
    return features(pa.array([term]))[0].tolist()


@dataclass
class Linear:
    words: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float

    def scores(self, column: pa.Array) -> np.ndarray:
        hashes, text, n = features(column)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
            known = self.words[at] == hashes
            text, word = np.divmod(np.unique(text[known] * len(self.words) + at[known]), len(self.words))
            logit = self.bias + np.bincount(text, self.weights[word], minlength=n)
        else:
            logit = np.full(n, self.bias)
        return 1 / (1 + np.exp(-np.clip(logit, -500, 500)))


def _word_sets(batches):
    for batch in batches:
        for piece in pieces(batch, TEXT):
            hashes, text, n = features(piece.column(TEXT))
            order = np.lexsort((hashes, text))
            hashes, text = hashes[order].view(np.int64), text[order]
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
            places = np.searchsorted(text[new], np.arange(n + 1)).astype(np.int32)
            flat = hashes[new]
            yield pa.RecordBatch.from_arrays(
                [*(piece.column(c) for c in KEY), pa.ListArray.from_arrays(pa.array(places), pa.array(flat))], names=[*KEY, "words"]
            )


def swaps(words: list[int], kinds: Sequence[Sequence[Sequence[int]]]) -> list[list[int]]:
    """A set with each group term (a word, then its beginnings) swapped for every other of its kind."""
    own, out = set(words), []
    for kind in kinds:
        for term in kind:
            if term[0] in own:
                out += [sorted(own.difference(term).union(other)) for other in kind if other is not term]
    return out


def insertions(sets: list, kinds: Sequence[Sequence[Sequence[int]]]) -> Counter:
    """How often a term put into a set, and then the next of its kind, differ by which words.

    Only words that the set lacks and the two terms don't share can change the logit, so
    most sets give the same differences, which are counted.
    """
    out = Counter()
    for s in sets:
        own = set(np.asarray(s).tolist())
        for kind in kinds:
            added = [frozenset(term) - own for term in kind]
            for a, b in zip(added, added[1:] + added[:1], strict=True):
                out[a - b, b - a] += 1
    return out


class Rows:
    """Sets of word numbers, as one flat array."""

    def __init__(self, sets: list, width: int):
        self.row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        self.word = np.concatenate([np.zeros(0, np.int64), *[np.asarray(s, np.int64) for s in sets]]).astype(np.int64)
        self.n, self.width = len(sets), width

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.word], minlength=self.n)

    def back(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, x[self.row], minlength=self.width)


def train(sets: list, labels: np.ndarray, vocabulary: list[int], identities=IDENTITIES, pair: float = PAIR):
    """Weights of the vocabulary's words, and the bias; both labels weigh the same in all."""
    number = {h: i for i, h in enumerate(vocabulary)}
    kinds = [[[number[h] for h in term_features(t)] for t in kind] for kind in identities]
    given = Rows(sets, len(vocabulary))
    original, swapped = [], []
    for s in sets:
        for other in swaps(np.asarray(s).tolist(), kinds):
            original.append(s)
            swapped.append(other)
    put = sorted((sorted(a), sorted(b), n) for (a, b), n in insertions(sets, kinds).items())
    total = max(sum(n for _, _, n in put), 1)
    changes = [  # the two sides of each change, and the share of each in the penalty
        (original, swapped, np.full(len(original), 1 / max(len(original), 1))),
        ([a for a, _, _ in put], [b for _, b, _ in put], np.array([n / total for _, _, n in put])),
    ]
    changes = [(Rows(a, len(vocabulary)), Rows(b, len(vocabulary)), part) for a, b, part in changes if len(part)]
    share = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    w, bias = np.zeros(len(vocabulary)), 0.0
    seen_w, seen_b = np.full(len(vocabulary), 1e-8), 1e-8  # adaptive steps
    for _ in range(ROUNDS):
        error = (1 / (1 + np.exp(-np.clip(given.times(w) + bias, -500, 500))) - labels) * share
        slope = given.back(error)
        for before, after, part in changes:
            change = 2 * pair * (before.times(w) - after.times(w)) * part
            slope += before.back(change) - after.back(change)
        seen_w += slope**2
        seen_b += error.sum() ** 2
        step = RATE / np.sqrt(seen_w)
        w = w - step * slope
        w = np.sign(w) * np.maximum(np.abs(w) - step * SPARSE, 0)
        bias -= RATE / np.sqrt(seen_b) * error.sum()
    return w, bias


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    identities=IDENTITIES,
) -> Linear | None:
    """Learns from the labelled rows that are not held out; None where a label is missing."""
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("_llm_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("_llm_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out("_llm_id"))
    known = known.groupBy("_llm_id").agg(F.max("label").alias("label"))
    ids = []
    for label in (0, 1):
        picked = known.where(F.col("label") == label).orderBy(F.xxhash64("_llm_id"), "_llm_id").limit(SAMPLE)
        ids += [(r[0], r[1]) for r in picked.collect()]
    if len({label for _, label in ids}) < 2:
        return None
    chosen = spark.createDataFrame(ids, known.schema)
    given = docs.select(F.col(id_col).alias("_llm_id"), F.col(text_col).alias(TEXT))
    # at most 2 * SAMPLE ids are sent; rows of equal text and label count once
    sample = given.join(F.broadcast(chosen), "_llm_id").groupBy("label", TEXT).agg(F.min(F.xxhash64("_llm_id")).alias("by_id"))
    sample = sample.select("label", "by_id", F.xxhash64(TEXT).alias("by_text"), TEXT)
    sets = stored(sample.mapInArrow(_word_sets, "label int, by_id long, by_text long, words array<long>"), "word-sets")
    # an id may have any number of texts: the last one of each label that counts
    last = []
    for label in (0, 1):
        keys = sets.select(*KEY).where(F.col("label") == label).orderBy(*KEY).limit(SAMPLE)
        last += [tuple(r) for r in keys.agg(F.max(F.struct(*KEY)).alias("key")).select("key.*").collect() if r[0] is not None]
    within = [F.struct(*KEY) <= F.struct(*[F.lit(x).cast(t) for x, t in zip(key, ("int", "long", "long"))]) for key in last]
    mine = [(F.col("label") == key[0]) & ok for key, ok in zip(last, within)]
    sets = sets.where(reduce(operator.or_, mine, F.lit(False)))
    often = sets.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    often = often.where(F.col("n") >= LEAST).orderBy(F.desc("n"), "word").limit(VOCABULARY)
    # group terms always have a weight, for a swap may bring in one that no text has
    terms = [h for kind in identities for t in kind for h in term_features(t)]
    known_words = np.array(terms, np.uint64).view(np.int64)
    vocabulary = np.union1d(np.array([r.word for r in often.collect()], np.int64), known_words)
    sent = spark.sparkContext.broadcast(vocabulary)

    def narrow(batches):
        words = sent.value
        for batch in batches:
            column = batch.column("words")
            offsets = column.offsets.to_numpy()
            flat = column.values.to_numpy()
            rows = []
            for a, b in zip(offsets, offsets[1:]):
                at = np.searchsorted(words, flat[a:b])
                ok = at < len(words)
                ok[ok] = words[at[ok]] == flat[a:b][ok]
                rows.append(at[ok].astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.int32()))], names=["label", "words"])

    table = sets.mapInArrow(narrow, "label int, words array<int>").toArrow()
    # as bytes: the sets of all samples are no Python objects at once
    order = sorted(
        (label, words.values.to_numpy().astype(np.int32).tobytes())
        for label, words in zip(table["label"].to_pylist(), table["words"], strict=True)
    )
    got = np.array([label for label, _ in order])
    if len(set(got.tolist())) < 2:
        return None
    hashes = vocabulary.view(np.uint64)
    w, bias = train([np.frombuffer(s, np.int32) for _, s in order], got, hashes.tolist(), identities)
    some = np.flatnonzero(w)
    by = some[np.argsort(hashes[some])]
    return Linear(hashes[by], w[by], float(bias))


def score(docs: DataFrame, model: Linear | None, text_col: str = "text") -> DataFrame:
    """``docs`` with score and predicted (1 from ``THRESHOLD`` on)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def build():
        def work(piece: pa.RecordBatch):
            model = sent.value
            if model is None:
                scores = np.zeros(piece.num_rows)
            else:
                scores = model.scores(piece.column(TEXT))
            return pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))

        return work

    return append_columns(docs, text_col, FIELDS, build)
