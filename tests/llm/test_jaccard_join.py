import random

import numpy as np
import pyarrow as pa
import pytest

from blotterflow.llm import jaccard_join as jj
from tests.llm.brute import BLANK, fold

SCHEMA = "doc_id long, text string"


def brute(rows):
    """(doc_id, n_shingles, component_id), sorted."""
    sets = []
    for _, text in rows:
        w = BLANK.findall(fold(text or ""))
        sets.append({tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 85 * (len(x) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        if name is not None:
            r = find(i)
            least[r] = min(least.get(r, name), name)
    return sorted(((n, len(s), least.get(find(i)) if s else n) for i, ((n, _), s) in enumerate(zip(rows, sets))), key=str)


def run(spark, rows, schema=SCHEMA):
    got = jj.jaccard_classes(spark.createDataFrame(rows, schema))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted(map(tuple, got.collect()), key=str)


def near_copies(seed, groups, size, words, edits, first=0):
    pick = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{pick.randrange(4000)}" for _ in range(words)]
        for _ in range(size):
            w = list(base)
            for _ in range(pick.randrange(edits + 1)):
                w[pick.randrange(len(w))] = f"x{pick.randrange(10**6)}"
            rows.append((first + len(rows), " ".join(w)))
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,words,edits", [(1, 60, 3), (2, 200, 8)])
def test_as_brute_force(spark, seed, words, edits):
    rows = near_copies(seed, 12, 14, words, edits)
    want = brute(rows)
    sizes = [sum(w[2] == c for w in want) for c in {w[2] for w in want}]
    assert max(sizes) > 5 and min(sizes) == 1
    assert run(spark, rows) == want


def test_links_at_the_limit_and_one_below(spark):
    # 4 words shared: 20 of 23 shingles are 86.9 %, 17 of 20 are 85 %, 16 of 19 are 84.2 %
    rows = []
    for k, n in enumerate((23, 20, 19)):
        words = [f"t{k}_{i}" for i in range(n + 3)]
        rows += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(words[:-3]))]
    got = {i: c for i, _, c in run(spark, rows)}
    assert run(spark, rows) == brute(rows)
    assert (got[1], got[11], got[21]) == (0, 10, 21)


def test_a_hot_group_is_not_paired_with_itself(spark):
    rows = near_copies(5, 1, 300, 120, 4) + near_copies(6, 20, 3, 50, 1, first=1000)
    assert run(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"v{i % 997}_{i % 13}" for i in range(40000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One TWO"), (6, "one two three four"), (6, "one two three four")]
    rows += [(None, "one two"), (None, "lonely words stand here"), (7, "lonely words stand here"), (None, None), (8, long), (9, long + " end"), (10, "é É é é x"), (11, "a a a a a a a")]
    assert run(spark, rows) == brute(rows)


def test_empty_and_extra_columns(spark):
    assert run(spark, []) == []
    rows = [(i, t, "k", 7, None) for i, t in near_copies(8, 3, 4, 40, 1)]
    assert run(spark, rows, SCHEMA + ", key string, n int, component_id long") == brute([r[:2] for r in rows])


def test_filters_never_cost_a_link():
    pick = random.Random(4)
    rows = near_copies(9, 4, 12, 70, 6)
    column = pa.array([t for _, t in rows])
    text, hashes = jj.shingle_sets(column)
    sketch = jj.sketches(text, hashes, len(rows))
    sets = [set(hashes[text == i].tolist()) for i in range(len(rows))]
    for _ in range(400):
        a, b = pick.randrange(len(rows)), pick.randrange(len(rows))
        odd = sum(int(x).bit_count() for x in (sketch[a] ^ sketch[b]).view(np.uint64))
        assert odd <= len(sets[a] ^ sets[b])
