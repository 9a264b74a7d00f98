import random

import numpy as np
import pytest

from blotterflow.llm.decontaminate import clean_documents, contamination, suffix_array
from tests.llm import brute

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def result(df):
    return {r.doc_id: (r.n_words, r.n_hit, list(r.item_ids), r.contaminated) for r in df.collect()}


def corpus(seed):
    pick = random.Random(seed)
    word = lambda n=60: f"W{pick.randrange(n)}é"
    items = [(i, " ".join(word() for _ in range(pick.choice([0, 1, 3, 12, 13, 14, 30])))) for i in range(25)]
    items += [(3, items[5][1]), (None, " ".join(word() for _ in range(20))), (99, None)]
    rows = []
    for i in range(80):
        words = [word() for _ in range(pick.randrange(0, 90))]
        for _ in range(pick.randrange(3)):
            at = pick.randrange(len(words) + 1)
            own = (pick.choice(items)[1] or "").split()
            words[at:at] = own[pick.randrange(2) :]
        rows.append((i, pick.choice([" ", ", ", "-\n"]).join(words)))
    return rows, items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block", [4 << 20, 300])
def test_as_brute_force(spark, seed, block):
    rows, items = corpus(seed)
    out = contamination(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS), block_bytes=block)
    got = result(out)
    assert got == brute.contamination(rows, items)
    assert any(v[3] for v in got.values()) and not all(v[3] for v in got.values())


def test_matches_are_longest_and_placed(spark):
    item = " ".join(f"q{i}" for i in range(40))
    text = "a b " + " ".join(f"q{i}" for i in range(5, 30)) + " c " + item
    (row,) = contamination(spark.createDataFrame([(1, text)], DOCS), spark.createDataFrame([(7, item)], ITEMS)).collect()
    assert [tuple(m) for m in row.matches] == [("7", 5, 2, 25), ("7", 0, 28, 40)]
    assert row.n_hit == 65


def test_edges(spark):
    long = " ".join(f"a{i}" for i in range(20_000))
    rows = [(1, None), (2, ""), (3, "..."), (4, "one"), (5, long), (5, long), (None, "ONE two")]
    items = [(1, "one"), (2, long), (3, ""), (4, None)]
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    assert result(contamination(docs, bench)) == brute.contamination(rows, items)
    assert contamination(docs.limit(0), bench).count() == 0
    none = contamination(docs, bench.limit(0)).collect()
    assert len(none) == 7 and not any(r.n_hit or r.contaminated for r in none)


def test_clean_documents_keep_their_columns(spark):
    item = " ".join(f"q{i}" for i in range(15))
    rows = [(1, item, "x", 1.5), (2, "fine " * 30, None, 2.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches string, N_hit double")
    out = clean_documents(docs, spark.createDataFrame([(1, item)], ITEMS))
    assert out.columns == docs.columns
    assert [tuple(r) for r in out.collect()] == [rows[1]]


def test_suffix_array_order():
    pick = random.Random(4)
    words = np.array([pick.randrange(3) for _ in range(200)], np.uint64)
    last = np.repeat([50, 120, 200], [50, 70, 80])
    order = suffix_array(words, last, np.arange(200), 200)
    suffixes = [tuple(words[i : last[i]].tolist()) for i in order]
    assert suffixes == sorted(suffixes)


def test_one_word_over_and_over(spark):
    rows, items = [(1, "na " * 20_000), (2, "na " * 12), (3, "na " * 2_500)], [(1, "NA " * 2_000), (2, "na " * 300), (3, "na")]
    out = contamination(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS))
    got = {r.doc_id: r for r in out.collect()}
    assert result(out) == {
        1: (20_000, 20_000, ["1", "2", "3"], True),
        2: (12, 12, ["3"], True),
        3: (2_500, 2_500, ["1", "2", "3"], True),
    }
    assert tuple(got[1].matches[0]) == ("1", 0, 0, 2_000) and got[1].match_sharers[0] == 1
    # 501 places have all of item 1 before them; the last 12 have a window of item 3 alone
    assert len(got[3].matches) == 501 + 12


def test_passage_that_items_and_texts_share(spark):
    shared = " ".join(f"s{i}" for i in range(40))
    items = [(i, f"head{i} {shared} tail{i}") for i in range(1_000)] + [(5_000, " ".join(f"o{i}" for i in range(20)))]
    rows = [(i, f"begin{i} {shared} end{i}") for i in range(1_000)] + [(5_000, "clean text")]
    out = contamination(spark.createDataFrame(rows, DOCS).coalesce(1), spark.createDataFrame(items, ITEMS)).collect()
    names = sorted(str(i) for i in range(1_000))
    for r in out:
        if r.doc_id == 5_000:
            assert not r.item_ids and not r.matches
        else:
            assert r.n_hit == 40 and list(r.item_ids) == names
            assert [tuple(m)[1:] for m in r.matches] == [(1, 1, 40)] and r.match_sharers == [1_000]


def test_deep_ties_are_sorted_by_doubling():
    pick = random.Random(5)
    words = np.concatenate([np.zeros(300, np.uint64), np.tile(np.array([1, 2], np.uint64), 200), np.zeros(250, np.uint64)])
    last = np.repeat([300, 700, 950], [300, 400, 250])
    places = np.array(sorted(pick.sample(range(950), 600)))
    order = suffix_array(words, last, places, 950)
    suffixes = [tuple(words[i : last[i]].tolist()) for i in order]
    assert suffixes == sorted(suffixes) and sorted(order.tolist()) == places.tolist()
