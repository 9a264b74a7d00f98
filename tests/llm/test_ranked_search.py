import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from blotterflow.llm import ranked_search as rs
from tests.llm.brute import fold

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def brute(docs, items):
    """(item_id, rank, doc_id, score), sorted; items with one id are told apart by their place."""
    held = [(i, Counter(TERM.findall(fold(t or "")))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in held]
    n_all, words = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        query, found = Counter(TERM.findall(fold(text or ""))), []
        for (i, c), n in zip(held, sizes):
            score = 0
            for t, times in query.items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1)))
                    m = 75 + (25 * n * n_all) // words
                    score += times * w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, f[3], -f[0]) for k, f in enumerate(sorted(found, key=lambda f: f[:3])[:20])]
    return sorted(out, key=str)


def run(spark, docs, items, doc_schema=DOCS, item_schema=ITEMS):
    got = rs.search(spark.createDataFrame(docs, doc_schema), spark.createDataFrame(items, item_schema))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, got.collect()), key=str)


def table(seed, n, words, vocabulary=60):
    pick = random.Random(seed)
    names = [f"{'Ärx'[k % 3]}w{k}" for k in range(vocabulary)]
    weights = [1 / (k + 1) for k in range(vocabulary)]
    return [(i, ", ".join(pick.choices(names, weights, k=pick.randrange(words)))) for i in range(n)]


@pytest.mark.parametrize("block", [1 << 17, 90])
def test_as_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(rs, "BLOCK_TERMS", block)
    docs = table(1, 300, 60)
    items = table(2, 25, 40, 80)
    want = brute(docs, items)
    assert want and run(spark, docs, items) == want


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "-- !"), (4, "Same words, same WORDS"), (5, "same words same words"), (None, "same words same words")]
    docs += [(6, "a_b c"), (6, "a_b c"), (7, "word " * 30000), (8, "É é e")]
    items = [(1, "same"), (1, "words words"), (2, None), (3, ""), (None, "a B C"), (4, "é"), (5, "word " * 5000), (6, "nowhere")]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables_and_extra_columns(spark):
    assert run(spark, [], [(1, "a")]) == []
    assert run(spark, [(1, "a")], []) == []
    assert run(spark, [(1, None)], [(1, "a")]) == []
    got = run(spark, [(1, "a b", 5, "x")], [(2, "b", 7, 8)], DOCS + ", item int, score string", ITEMS + ", rank int, doc_id int")
    assert got == brute([(1, "a b")], [(2, "b")])


@pytest.mark.parametrize("seed", range(4))
def test_mined_nodes_sum_to_the_queries(seed):
    pick = random.Random(seed)
    queries = [sorted({min(int(pick.expovariate(0.1)), 50) for _ in range(30)}) for _ in range(40)]
    nodes, sums = rs.mine(queries, 51, width=12)
    spread = [[s] for s in range(51)]
    for a, b in nodes:
        spread.append(spread[a] + spread[b])
    assert [sorted(s for p in q for s in spread[p]) for q in sums] == queries
    plain = sum(len(q) - 1 for q in queries)
    assert nodes and len(nodes) + sum(len(q) - 1 for q in sums) < plain
    assert not rs.mine([[0, 1], [2]], 3)[0]


def test_a_part_shared_by_all_is_summed_once():
    queries = [[0, 1, 2, 3 + i] for i in range(10)]
    nodes, sums = rs.mine(queries, 13)
    assert len(nodes) == 2 and all(len(q) == 2 for q in sums)


def test_best_keeps_the_first_of_equals():
    best = rs.Best(1)
    pick = np.random.default_rng(3)
    scores, ids = pick.integers(0, 9, (1, 500)), pick.permutation(500)
    for low in range(0, 500, 50):
        best.add(scores[:, low : low + 50], ids[low : low + 50])
    want = sorted((-s, i) for s, i in zip(scores[0].tolist(), ids.tolist()) if s)[:20]
    assert [(-s, i) for s, i in zip(best.score.tolist(), best.id.tolist())] == want
