import random
import zlib

import numpy as np
import pyarrow as pa

from blotterflow.llm import language_id as L

SCHEMA = "doc_id long, text string, lang string"
PARTS = {"xx": "tha ther ing and of wh sh ea".split(), "yy": "sch ung keit der ein zu pfl ü".split(), "zz": "eau tion ç le ré oi ent qu".split()}


def sentence(pick, lang, n):
    return " ".join("".join(pick.choice(PARTS[lang]) for _ in range(pick.randrange(1, 4))) for _ in range(n))


def rows(seed, n=300):
    pick = random.Random(seed)
    langs = sorted(PARTS)
    return [(i, sentence(pick, langs[i % 3], pick.randrange(8, 120)), langs[i % 3]) for i in range(n)]


def test_held_out_accuracy(spark):
    given = rows(1)
    out = L.identify(spark.createDataFrame(given, SCHEMA)).withColumn("held", L.held_out("doc_id")).collect()
    assert len(out) == 300
    for r in out:
        assert r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and not r.rejected
    held = [r for r in out if r.held]
    assert held and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97


def test_held_out_rows_teach_nothing(spark):
    given = rows(2)
    twisted = [(i, t, "qq" if zlib.crc32(str(i).encode()) % 3 == 1 else g) for i, t, g in given]
    a = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(spark.createDataFrame(given, SCHEMA)).collect()}
    b = {r.doc_id: (r.lang_pred, r.score) for r in L.identify(spark.createDataFrame(twisted, SCHEMA)).collect()}
    assert a == b


def test_rejects_what_is_no_language(spark):
    odd = [(1000, "привет это совсем другой язык " * 20, "xx"), (1001, "12345 ... !!", "yy"), (1002, None, "zz"), (1003, "", None), (1004, "tha", None)]
    out = {r.doc_id: r for r in L.identify(spark.createDataFrame(rows(3) + odd, SCHEMA)).collect()}
    assert out[1000].rejected and out[1000].lang_pred in PARTS
    for i in (1001, 1002, 1003):
        assert out[i].rejected and out[i].lang_pred == "und" and out[i].score == 0
    assert out[1004].lang_pred == "xx" and not out[1004].rejected


def test_edges(spark):
    given = [*rows(4), (None, "tha ther ing " * 5000, None), (7, "schung derein", "yy"), (7, "schung derein", "yy")]
    df = spark.createDataFrame([(*r, 1, 2) for r in given], SCHEMA + ", SCORE int, hash int")
    out = L.identify(df)
    assert out.columns == ["doc_id", "text", "lang", "hash", "lang_pred", "score", "similarity", "rejected"]
    got = out.collect()
    assert len(got) == len(given)
    assert [r.lang_pred for r in got if r.doc_id is None] == ["xx"]
    assert L.identify(df.limit(0)).count() == 0
    unlabelled = spark.createDataFrame([(1, "tha", None)], SCHEMA)
    assert [(r.lang_pred, r.rejected) for r in L.identify(unlabelled).collect()] == [("und", True)]
    kept = L.accepted(df)
    assert kept.columns == df.columns and kept.count() == len(given)


def test_counts_as_brute_force():
    texts = ["Ab, c", "", None, "ü!!a  b", "x", "ab" * 300]
    got = np.concatenate([c for _, c in L.counts(pa.array(texts, pa.string()))])
    plain = ["ab c", "", "", "ü a b", "x", "ab" * 300]
    for row, text in zip(got, plain):
        data = text.encode()
        assert row.sum() == sum(max(0, len(data) - n + 1) for n in L.GRAMS)
        distinct = {data[i : i + n] for n in L.GRAMS for i in range(len(data) - n + 1)}
        assert (row > 0).sum() <= len(distinct) and ((row > 0).any() == bool(distinct))


def test_blocks_of_rows_change_nothing():
    pick = random.Random(5)
    texts = [sentence(pick, "xx", pick.randrange(5)) for _ in range(3 * L.ROWS + 5)]
    whole = np.concatenate([c for _, c in L.counts(pa.array(texts))])
    single = np.concatenate([next(L.counts(pa.array([t])))[1] for t in texts])
    assert (whole == single).all()


def test_copies_leave_no_language_out(spark):
    pick = random.Random(6)
    given = [(sentence(pick, "xx", 40), f"l{i}") for i in range(8)]
    copies = spark.createDataFrame(given, "text string, lang string").crossJoin(spark.range(3000)).drop("id")
    assert L.fit(copies).langs == [f"l{i}" for i in range(8)]


def test_sample_is_the_smallest_hashes(spark):
    texts = spark.range(3 * L.SAMPLE).selectExpr("concat('tha ', id) as text", "'xx' as lang")
    texts = texts.union(texts.limit(1).crossJoin(spark.range(20_000)).drop("id")).union(spark.createDataFrame([("sch", "yy")] * 9, "text string, lang string"))
    known = texts.withColumnRenamed("text", L.TEXT)
    want = sorted(r.h for r in known.where("lang = 'xx'").selectExpr(f"xxhash64({L.TEXT}) as h").distinct().collect())[: L.SAMPLE]
    got = L._sample(known).collect()
    assert sorted(r.hash for r in got if r.lang == "xx") == want
    assert [r[L.TEXT] for r in got if r.lang == "yy"] == ["sch"]
