import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blotterflow.llm.quality_rules import BUCKETS, PRIOR, STRAY, fit, low_score, quality
from blotterflow.llm.words import BASE
from tests.llm import brute
from tests.llm.test_language_id import sentence

SCHEMA = "doc_id long, text string"


def base(text):
    text = text or ""
    words = brute.BLANK.findall(text)
    runs = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = {k for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if brute.BLANK.search(line):
            again += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(hit), failed


def texts(seed):
    pick = random.Random(seed)
    known = sentence(pick, "xx", 40).split()  # texts share their words, as those of a language do
    rows = []
    for i in range(300):
        text = " ".join(pick.choice(known) for _ in range(pick.randrange(0, 60)))
        if i % 5 == 0:
            text = " ".join(f"{w}{pick.choice(['%%%', '&&&', '###'])}" for w in text.split())
        lines = [text[k : k + 40] for k in range(0, len(text), 40)]
        lines += [pick.choice(lines or [""]) for _ in range(pick.randrange(3))]
        rows.append((i, pick.choice(["\n", "\n\n", "\r\n", "\n \t\n"]).join(lines) + pick.choice(["", "\n", " é😀"])))
    loop = "la li lu le lo "
    return [*rows, (900, None), (901, ""), (902, loop * 9), (903, loop + sentence(pick, "yy", 50) + " " + loop), (904, "\n\n\n"), (905, " a\n a\na")]


@pytest.fixture(scope="module")
def judged(spark):
    rows = texts(1)
    docs = spark.createDataFrame(rows, SCHEMA)
    trusted = spark.createDataFrame([(i,) for i in range(300) if i % 5 and i % 2], "doc_id long")
    return rows, quality(docs, trusted).collect()


def test_base_counts_as_brute_force(judged):
    rows, out = judged
    want = {i: base(t) for i, t in rows}
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in out}
    assert got == want


def test_ratio_keeps_what_is_like_the_trusted(judged):
    _, out = judged
    rest = [r for r in out if r.doc_id < 300 and not r.base_failed]
    good = [r.kept for r in rest if r.doc_id % 5]
    bad = [r.kept for r in rest if r.doc_id % 5 == 0 and r.n_words >= 10]
    assert all(good) and sum(bad) <= 0.1 * len(bad)
    assert not any(r.kept for r in out if r.base_failed)


def test_length_cancels_out(spark):
    rows = texts(2)
    text = next(t for i, t in rows if i == 1)
    docs = spark.createDataFrame([*rows, (999, " ".join([text] * 500))], SCHEMA)
    out = {r.doc_id: r for r in quality(docs, spark.createDataFrame([(7,)], "doc_id long")).collect()}
    assert abs(out[1].score - out[999].score) < 0.05 and out[999].base_failed


def test_edges(spark):
    good = sentence(random.Random(3), "zz", 30)
    rows = [(1, good, 1, 2), (1, good, 1, 2), (None, good, 3, 4)]
    df = spark.createDataFrame(rows, SCHEMA + ", KEPT int, bucket int")
    none = spark.createDataFrame([], "doc_id long")
    out = quality(df, none)
    assert [c for c in out.columns if c in ("doc_id", "text", "bucket", "KEPT")] == ["doc_id", "text", "bucket"]
    assert all(r.kept and r.score == 0 for r in out.collect())
    assert quality(df.limit(0), none).count() == 0
    assert quality(df, spark.createDataFrame([(1,), (1,), (None,)], "doc_id long")).count() == 3


def test_a_little_junk_is_enough_to_fail(spark):
    """Trusted texts score alike, so a text well below all of them isn't kept."""
    pick = random.Random(4)
    known = sentence(pick, "xx", 40).split()
    rows = []
    for i in range(400):
        words = [pick.choice(known) for _ in range(100)]
        if i % 4 == 0:
            words[3] = "%%%"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, SCHEMA)
    out = quality(docs, spark.createDataFrame([(i,) for i in range(400) if i % 4], "doc_id long")).collect()
    least = min(r.score for r in out if r.doc_id % 4)
    junk = [r for r in out if r.doc_id % 4 == 0 and r.score < least]
    assert not any(r.base_failed for r in out) and len(junk) > 90 and min(r.score for r in junk) > least - 0.1
    assert not any(r.kept for r in junk) and sum(r.kept for r in out if r.doc_id % 4) >= 297


def test_every_trusted_text_counts(spark):
    """Where all texts are trusted, both models are the same."""
    docs = spark.range(20_500).selectExpr("id as doc_id", "concat('w', id, ' of') as text")
    assert not fit(docs, docs).weights.any()


def mixed(h):
    h ^= h >> 32
    h = h * 0xD6E8FEB86659FD93 % 2**64
    h ^= h >> 29
    h = h * 0xA0761D6478BD642F % 2**64
    return h ^ h >> 32


def run_hash(items):
    return mixed(sum(x * pow(BASE, i, 2**64) for i, x in enumerate(items)) % 2**64)


def buckets(text):
    words = [run_hash([b + 1 for b in w.encode()]) for w in brute.BLANK.findall(text or "")]
    return [mixed(w) % BUCKETS for w in words] + [run_hash(p) % BUCKETS for p in zip(words, words[1:])]


def test_scores_and_verdicts_as_brute_force(judged):
    rows, out = judged
    held = {i: buckets(t) for i, t in rows}
    corpus = Counter(b for x in held.values() for b in x)
    trusted = [i for i in range(300) if i % 5 and i % 2]
    own = Counter(b for i in trusted for b in held[i])
    share = sum(own.values()) / sum(corpus.values())
    weight = {b: math.log((own[b] + PRIOR) / (n * share + PRIOR)) for b, n in corpus.items()}
    scores = {i: sum(weight[b] for b in x) / max(len(x), 1) for i, x in held.items()}
    got = {r.doc_id: r for r in out}
    assert all(abs(scores[i] - got[i].score) < 1e-9 for i in scores)
    limit = sorted(got[i].score for i in trusted)[math.floor(STRAY * len(trusted))]
    assert all(r.kept == (not r.base_failed and r.score >= limit) for r in out)


@pytest.mark.parametrize("share", [0.0, 0.005, 0.37, 0.9999])
def test_threshold_is_exact(spark, share):
    pick = random.Random(5)
    values = [round(pick.gauss(-0.3, 0.05), pick.choice([2, 5, 17])) for _ in range(3000)]
    scored = spark.createDataFrame([(v,) for v in values], "score double")
    assert low_score(scored, share) == sorted(values)[math.floor(share * len(values))]


def test_threshold_does_not_depend_on_partitions(spark):
    docs = spark.range(60_000).selectExpr(
        "id as doc_id", "concat('w', id % 701, ' w', id % 97, ' of w', pmod(hash(id), 500), if(id % 3 = 0, ' #', '')) as text"
    )
    trusted = docs.where("doc_id % 3 <> 0 or doc_id % 7 = 0").select("doc_id")
    found = {fit(docs.repartition(n, F.rand(n)), trusted.repartition(n)).threshold for n in (3, 17, 64)}
    assert len(found) == 1
