import random

import pytest
from pyspark.sql import functions as F

from blotterflow.llm.substring_dedup import substring_dedup
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def digests(df):
    rows = df.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    return {r[0]: tuple(r)[1:] for r in rows}


def shared_passages(seed):
    """Texts over a small vocabulary, with passages, near copies and loops."""
    pick = random.Random(seed)
    word = lambda n=400: f"w{pick.randrange(n)}"
    passages = [[word() for _ in range(pick.choice([19, 20, 21, 33, 60]))] for _ in range(5)]
    rows = []
    for i in range(60):
        words = [word() for _ in range(pick.randrange(0, 80))]
        for _ in range(pick.randrange(0, 3)):
            at = pick.randrange(len(words) + 1)
            words[at:at] = pick.choice(passages)[pick.randrange(3) :]
        if rows and pick.random() < 0.3:
            words = rows[pick.randrange(len(rows))][1].split()
            if words and pick.random() < 0.7:
                words[pick.randrange(len(words))] = word()
        if pick.random() < 0.1:
            words += ["la"] * pick.randrange(18, 60)
        rows.append((i * 3, pick.choice([" ", "  ", "\n", "\t"]).join(words)))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_brute_force(spark, seed):
    rows = shared_passages(seed)
    got = digests(substring_dedup(spark.createDataFrame(rows, SCHEMA)))
    assert got == brute.substring_dedup(rows)
    assert any(removed for _, removed, _ in got.values())


def test_edges(spark):
    long = " ".join(f"a{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, long), (6, "x " + long), (7, "é b \x00 c")]
    assert digests(substring_dedup(spark.createDataFrame(rows, SCHEMA))) == brute.substring_dedup(rows)
    assert substring_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_ids_missing_and_repeated(spark):
    text = " ".join(f"a{i}" for i in range(40))
    rows = [(None, text), (5, text), (9, text), (9, "z " + text), (9, text)]
    out = substring_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    removed = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in out)
    assert removed == [(0, 40, 40), (5, 40, 0), (9, 40, 40), (9, 40, 40), (9, 41, 40)]


def test_columns_with_clashing_names(spark):
    rows = [(1, "a b", "x", 7, 1), (2, "c", "y", 8, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, N_WORDS int, key int")
    out = substring_dedup(df)
    assert out.columns == ["doc_id", "text", "spans", "key", "n_words", "n_removed", "kept_text", "removed_spans"]
    assert sorted((r.doc_id, r.spans, r.key, r.n_words) for r in out.collect()) == [(1, "x", 1, 2), (2, "y", 2, 1)]


def test_spans_are_maximal(spark):
    text = " ".join(f"a{i}" for i in range(50))
    rows = [(1, text), (2, "x y " + text + " z")]
    (row,) = substring_dedup(spark.createDataFrame(rows, SCHEMA)).where("doc_id = 2").collect()
    assert [tuple(s) for s in row.removed_spans] == [(2, 50)]
    assert row.kept_text == "x y z"
