"""Language ID by nearest centroid over TF-IDF vectors of hashed byte n-grams.

Fitting reads all labelled rows for document frequencies, which are summed in Spark.
Centroids come from at most ``SAMPLE`` texts of each language, those with the smallest
hashes: each language is one task, where spherical k-means makes ``CENTROIDS``
centroids. A text gets the language of the centroid with the greatest cosine. It is
rejected if it lies further from it than ``REACH`` times (in cosine) the far end of the
language's own texts: then it is like none of the languages.

The score is the share of the language among all, each language weighing
exp(cosine / ``SHARPNESS``).

Cases: a text that is null or has no letter is ``und``, rejected, with score 0; so is
every text if there is nothing to learn from. Rows without a language, or held out, are
not learned from. Equal centroids: the language first in order. Repeated rows count as
often as they stand, but one of them is in the sample. An empty table gives no rows.
Columns of the input with the names of the output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField

from blotterflow.llm.batches import TEXT, append_columns, hidden, pieces, strings, text_bytes
from blotterflow.llm.tables import discard, stored
from blotterflow.llm.words import FOLD, byte_class

BUCKETS = 1 << 13
GRAMS = (2, 3)
#: At most so many texts of a language make its centroids.
SAMPLE = 600
CENTROIDS, ROUNDS, LEAST = 4, 10, 0.02
#: A table of at most so many languages is sent to executors.
LANGUAGES = 10_000
REACH, SHARPNESS = 0.3, 0.05
#: A text of fewer n-grams than this is expected to lie further off, by the square root.
FULL = 200
ROWS = 128
PLAIN = np.where(byte_class((0x61, 0x7A), (0x80, 0xFF))[FOLD], FOLD, 0x20).astype(np.uint8)

FIELDS = [
    StructField("lang_pred", StringType()),
    StructField("score", DoubleType()),
    StructField("similarity", DoubleType()),
    StructField("rejected", BooleanType()),
]
_LETTER = regex.compile(r"\p{L}")


def held_out(id_col: str) -> Column:
    """Rows kept for testing: a third, by id. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def _letters(data: np.ndarray, places: np.ndarray):
    """Folded letters, with one blank for whatever stands between them."""
    data = PLAIN[data]
    blank = data == 0x20
    before = np.zeros(len(data) + 1, bool)
    before[1:] = blank
    before[places] = True
    kept = ~(blank & before[:-1])
    return data[kept].astype(np.uint32), np.concatenate([[0], np.cumsum(kept)])[places]


def counts(column: pa.Array):
    """Blocks of at most ``ROWS`` texts: first row, and counts of n-grams by text and bucket."""
    data, places = _letters(*text_bytes(column))
    for low in range(0, len(column), ROWS):
        high = min(low + ROWS, len(column))
        begin, end = places[low], places[high]
        own = data[begin:end]
        row = np.repeat(np.arange(high - low), np.diff(places[low : high + 1]))
        total = np.zeros((high - low) * BUCKETS, np.int64)
        for n in GRAMS:
            if len(own) < n:
                continue
            code = own[: len(own) - n + 1].copy()
            for k in range(1, n):
                code = code << np.uint32(8) | own[k : len(own) - n + 1 + k]
            code = (code * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B % (1 << 32))) >> np.uint32(19)
            inside = row[n - 1 :] == row[: len(row) - n + 1]
            key = row[: len(code)] * BUCKETS + code
            total += np.bincount(key[inside], minlength=len(total))
        yield low, total.reshape(high - low, BUCKETS)


def vectors(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of log counts times inverse document frequency; a text without n-grams is zero."""
    v = np.log1p(count).astype(np.float32) * idf
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=v, where=norm > 0)


@dataclass
class Centroids:
    idf: np.ndarray
    langs: list[str]
    of: np.ndarray  # the language of each centroid, by number
    at: np.ndarray  # one column each
    floor: np.ndarray  # the least cosine of each language

    def nearest(self, v: np.ndarray):
        """Language number, cosine and score of each vector."""
        cosine = v @ self.at
        best = np.stack([cosine[:, self.of == i].max(axis=1) for i in range(len(self.langs))], axis=1)
        lang = best.argmax(axis=1)
        top = best.max(axis=1)
        weight = np.exp((best - top[:, None]) / SHARPNESS)
        return lang, top, 1 / weight.sum(axis=1)


def _document_frequencies(batches):
    total, n = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for piece in pieces(batch, TEXT):
            for _, count in counts(piece.column(TEXT)):
                total += (count > 0).sum(axis=0)
                n += len(count)
    if n:
        buckets = np.append(np.flatnonzero(total), -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(buckets.astype(np.int32)), pa.array(np.append(total[buckets[:-1]], n))], names=["bucket", "n"]
        )


def spherical_means(v: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Unit centroids; the first is the mean, each next starts at the text least like those before."""
    at = [_unit(v.mean(axis=0))]
    near = v @ at[0]
    while len(at) < min(k, len(v)):
        at.append(v[near.argmin()])
        near = np.maximum(near, v @ at[-1])
    at = np.stack(at)
    for _ in range(rounds):
        own = (v @ at.T).argmax(axis=1)
        new = np.stack([_unit(v[own == i].mean(axis=0)) if (own == i).any() else c for i, c in enumerate(at)])
        if np.array_equal(new, at):
            break
        at = new
    return at


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x)
    return x / norm if norm else x


def _cluster(idf: np.ndarray):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("hash").head(SAMPLE)
        texts = pa.array(rows[TEXT], pa.string())
        v = np.concatenate([vectors(c, idf) for _, c in counts(texts)])
        v = v[v.any(axis=1)]
        if not len(v):
            return pd.DataFrame({"lang": [], "centroid": [], "floor": []})
        at = spherical_means(v, CENTROIDS, ROUNDS)
        members = np.bincount((v @ at.T).argmax(axis=1), minlength=len(at))
        at = at[members >= min(members.max(), LEAST * len(v))]  # a few odd texts are no part of a language
        floor = REACH * float(np.quantile((v @ at.T).max(axis=1), 0.05))
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": [c.astype(np.float32).tobytes() for c in at], "floor": floor})

    return run


def _sendable(by_lang: DataFrame) -> DataFrame:
    """A written table of a row for each language, sent to executors if it is short."""
    few = by_lang.limit(LANGUAGES + 1).collect()
    # if it isn't, the rows have to be dealt by language
    return F.broadcast(by_lang.sparkSession.createDataFrame(few, by_lang.schema)) if len(few) <= LANGUAGES else by_lang


def _sample(known: DataFrame) -> DataFrame:
    """lang, hash and text of the ``SAMPLE`` smallest distinct hashes of each language, or of all if there are fewer.

    Distinct hashes are counted and ordered first, so that copies don't matter; texts are only
    shuffled if they are picked.
    """
    hashed = known.withColumn("hash", F.xxhash64(TEXT))
    distinct = stored(hashed.select("lang", "hash").distinct(), "hashes")
    share = stored(distinct.groupBy("lang").agg((2.0 * SAMPLE / F.count("*")).alias("share")), "shares")
    # some 2 * SAMPLE of each language: the SAMPLE smallest are among them
    near = distinct.join(_sendable(share), "lang").where(F.col("hash") / 2.0**64 + 0.5 <= F.col("share"))
    near = stored(near.select("lang", "hash"), "near-hashes")
    first = F.slice(F.array_sort(F.collect_list("hash")), 1, SAMPLE)
    last = stored(near.groupBy("lang").agg(F.array_max(first).alias("last")), "last-hashes")
    discard(distinct, share, near)
    picked = hashed.join(_sendable(last), "lang").where("hash <= last")
    return picked.select("lang", "hash", TEXT).dropDuplicates(["lang", "hash"])


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Centroids | None:
    """Learns from all rows of ``labelled`` with a language; None if there are none."""
    known = labelled.select(F.col(text_col).alias(TEXT), F.col(lang_col).alias("lang")).where(f"lang is not null and {TEXT} is not null")
    frequency = known.select(TEXT).mapInArrow(_document_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = {r.bucket: r.n for r in frequency.collect()}  # one row for each bucket
    if not found:
        return None
    seen = np.zeros(BUCKETS)
    n = found.pop(-1)
    seen[list(found)] = list(found.values())
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)

    sample = _sample(known)
    made = sample.groupBy("lang").applyInPandas(_cluster(idf), "lang string, centroid binary, floor double")
    rows = sorted(stored(made, "centroids").collect(), key=lambda r: (r.lang, r.centroid))
    if not rows:
        return None
    langs = sorted({r.lang for r in rows})
    floors = {r.lang: r.floor for r in rows}
    return Centroids(
        idf,
        langs,
        np.array([langs.index(r.lang) for r in rows]),
        np.stack([np.frombuffer(r.centroid, np.float32) for r in rows]).T.copy(),
        np.array([floors[x] for x in langs]),
    )


def predict(docs: DataFrame, model: Centroids | None, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score, similarity (the cosine) and rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def build():
        model = sent.value

        def work(piece: pa.RecordBatch):
            column = piece.column(TEXT)
            spoken = np.array([bool(t and _LETTER.search(t)) for t in column.to_pylist()], bool)
            n = len(spoken)
            lang, cosine, score, size = np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n)
            if model is None:
                spoken[:] = False
            else:
                for low, count in counts(column):
                    at = slice(low, low + len(count))
                    lang[at], cosine[at], score[at] = model.nearest(vectors(count, model.idf))
                    size[at] = count.sum(axis=1)
            rejected = ~spoken if model is None else ~spoken | (cosine < model.floor[lang] * np.sqrt(np.minimum(1, size / FULL)))
            names = [model.langs[i] if s else "und" for i, s in zip(lang.tolist(), spoken.tolist(), strict=True)]
            return strings(names), pa.array(score * spoken), pa.array(cosine * spoken), pa.array(rejected)

        return work

    return append_columns(docs, text_col, FIELDS, build)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Fits on the rows that are not held out, and predicts every row."""
    labelled = docs.where(~held_out(id_col)).select(F.col(text_col).alias(text_col), F.col(lang_col).alias(lang_col))
    return predict(docs, fit(labelled, text_col, lang_col), text_col)


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` in a language, as they are."""
    given = hidden(docs)
    names = [given.columns[docs.columns.index(c)] for c in (id_col, text_col, lang_col)]
    return identify(given, *names).where("not rejected").select(given.columns).toDF(*docs.columns)
