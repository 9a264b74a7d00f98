import random

import pytest
from pyspark.sql import functions as F

from blotterflow.operators import caps


@pytest.mark.parametrize("few", [0, 3, 1000])
def test_nth_key(spark, monkeypatch, few):
    monkeypatch.setattr(caps, "FEW", few)
    pick = random.Random(few)
    keys = ["".join(pick.choices("0aÄ\U0001f600", k=pick.randrange(6))) for _ in range(300)] + ["a", "a", "aa", "", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    want = sorted({k for k in keys if k is not None})
    for n in (1, 2, 7, len(want) - 1, len(want)):
        assert caps.nth_key(df, "k", n) == want[n - 1]
    assert caps.nth_key(df, "k", len(want) + 1) is None


def test_rows_among_the_first_keys(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "k string")
    for n, want in ((0, []), (1, ["a"]), (2, ["a", "b", "b"]), (9, ["a", "b", "b", "c"])):
        assert sorted(r.k for r in df.where(caps.among_first(df, "k", n)).collect()) == want


def test_no_task_holds_the_keys(spark):
    """A cap of a million keys is a filter: no sort, no limit, no exchange to one task."""
    df = spark.range(1_200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"))
    capped = df.where(caps.among_first(df, "k", 1_000_000))
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert capped.count() == 1_000_000
    assert not any(x in plan for x in ("Exchange", "Sort", "Limit", "TakeOrdered"))
