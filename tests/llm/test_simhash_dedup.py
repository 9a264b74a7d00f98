import random

import numpy as np
import pytest

from blotterflow.llm import simhash_dedup
from blotterflow.llm.gray_index import GrayIndex, cross_roots, gray_rank, self_roots
from blotterflow.llm.simhash_dedup import fingerprint, near_duplicates, one_of_each
from tests.llm import brute

SCHEMA = "doc_id long, text string"


def values(seed, n, centers=12, flips=6):
    pick = random.Random(seed)
    base = [pick.getrandbits(64) for _ in range(centers)]
    out = set()
    while len(out) < n:
        x = pick.choice(base)
        for _ in range(pick.randrange(flips)):
            x ^= 1 << pick.randrange(64)
        out.add(x)
    return np.array(sorted(out), np.uint64)


def test_gray_neighbours_differ_in_one_bit():
    order = sorted(range(256), key=lambda x: int(gray_rank(np.array([x], np.uint64))[0]))
    assert all((a ^ b).bit_count() == 1 for a, b in zip(order, order[1:]))


@pytest.mark.parametrize("seed", [1, 2])
def test_index_finds_every_pair(seed):
    v = values(seed, 600)
    v = v[np.argsort(gray_rank(v))]
    index = GrayIndex(v, np.zeros(1, np.int64))
    got = {
        (int(a), int(b))
        for q, p in index.search(v, np.zeros(len(v), np.int64), 4, np.arange(len(v)))
        for a, b in zip(q, p)
    }
    want = {(i, j) for i in range(len(v)) for j in range(i + 1, len(v)) if (int(v[i]) ^ int(v[j])).bit_count() <= 4}
    assert got == want and want


def test_roots_within_groups_and_across():
    v = values(3, 300)
    groups = np.array([0, 100, 101, 250])
    root = self_roots(v, groups, 4)
    for low, high in zip(groups, [*groups[1:], 300]):
        want = brute.components([(int(i), int(v[i])) for i in range(low, high)])
        assert [int(r) for r in root[low:high]] == [want[i] for i in range(low, high)]
    left, right = v[:120], v[120:]
    root = cross_roots(left, right, 4)
    want = {i: i for i in range(300)}
    pairs = [(i, j) for i in range(120) for j in range(120, 300) if (int(v[i]) ^ int(v[j])).bit_count() <= 4]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(want[i], want[j])
            changed |= want[i] != low or want[j] != low
            want[i] = want[j] = low
    assert [int(r) for r in root] == [want[i] for i in range(300)]


def texts(seed):
    pick = random.Random(seed)
    rows = []
    for i in range(150):
        words = [f"W{pick.randrange(300)}" for _ in range(pick.randrange(0, 120))]
        if rows and pick.random() < 0.5:
            words = (rows[pick.randrange(len(rows))][1] or "").split()
            if words and pick.random() < 0.7:
                words[pick.randrange(len(words))] = "changed"
        rows.append((i * 7, " ".join(words) if pick.random() < 0.95 else None))
    return rows


def result(df):
    return {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in df.collect()}


def test_as_brute_force(spark):
    rows = texts(5)
    prints = [(i, brute.simhash(t)) for i, t in rows]
    want = brute.components(prints)
    got = result(near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    assert got == {i: (p, want[i]) for i, p in prints}


def test_small_pages_meet(spark):
    """Values of one block spread over many pages are still compared."""
    v = values(9, 500, centers=2)
    df = spark.createDataFrame([(int(x) - (1 << 64) if x >> np.uint64(63) else int(x),) for x in v], "bits long")
    want = brute.components([(int(x), int(x)) for x in v])
    for page in (16, 1 << 16):
        links = simhash_dedup.fingerprint_links(df, page).collect()
        root = {int(x): int(x) for x in v}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            a, b = sorted((find(a % (1 << 64)), find(b % (1 << 64))))
            root[b] = a
        assert {x: find(x) for x in root} == want


def test_edges(spark):
    rows = [(None, "a b c d e"), (4, None), (3, ""), (9, "A B C D E"), (9, "A B C D E"), (8, "q " * 20_000)]
    out = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    got = sorted((r.doc_id or 0, r.fingerprint, r.component_id) for r in out)
    letters = f"{brute.simhash('a b c d e'):016x}"
    assert got == [
        (0, letters, 9),
        (3, "0" * 16, 3),
        (4, "0" * 16, 3),
        (8, f"{brute.simhash('q q q q'):016x}", 8),
        (9, letters, 9),
        (9, letters, 9),
    ]
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert fingerprint(b"one two") == brute.simhash("one two")


def test_one_of_each(spark):
    rows = [(2, "a b c d e f", 1), (1, "a b c d e f", 2), (1, "a b c d e f", 3), (7, "other words stand here now", 4), (None, "a b c d e f", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, bits int")
    out = one_of_each(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 7]
