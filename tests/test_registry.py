"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from blotterflow.plans.ingest import with_title_dates
from blotterflow.registry import inputs

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def tidy(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if str(df[name].dtype).startswith("datetime"):
            df[name] = df[name].dt.strftime("%Y-%m-%d")
        df[name] = df[name].map(lambda v: "NULL" if pd.isna(v) else repr(float(v)) if isinstance(v, float) else str(v))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_every_query_has_sql():
    """The corpus queries, which are optional, have tests of their own."""
    own = set(entry_points.QUERIES)
    assert own == set(entry_points.ORACLES) and own <= set(entry_points.oracle_sql())


def test_batches_make_up_the_table(spark):
    from blotterflow.registry import queries as Q

    old, new = Q._two_batches(spark, SF)
    keys = {r[0] for r in spark.read.parquet(f"{SF}/orders.parquet").select("o_orderkey").collect()}
    a, b = ({r[0] for r in x.select("o_orderkey").collect()} for x in (old, new))
    assert a | b == keys and a & b


def test_tables_of_one_name_are_kept_apart(spark, tmp_path):
    from blotterflow.registry import inputs

    few = f"{tmp_path}/sf0.001"
    spark.read.parquet(f"{SF}/orders.parquet").limit(10).write.parquet(f"{few}/orders.parquet")
    assert inputs.landed(spark, few).count() == 10 and inputs.landed(spark, SF).count() > 10


@pytest.mark.parametrize("name", list(entry_points.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = tidy(entry_points.queries()[name](spark, SF).toPandas())
    want = tidy(duck.execute(entry_points.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    pd.testing.assert_frame_equal(got, want)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert "total_incidents" in df.columns and df.count() > 0


def test_dates_stay_in_the_calendar_at_any_size(spark):
    """Keys up to a billion: every document has dates of the given years, one each unless its title has more."""
    orders = spark.range(1, 1_000_000_000, 999_983).selectExpr(
        "id as o_orderkey", "id % 1000 as o_custkey", "timestamp(date_add(date'1995-01-01', cast(id % 2405 as int))) as o_orderdate"
    )
    docs = with_title_dates(inputs.documents_of(orders.withColumn("day", F.to_date("o_orderdate"))), "beat_title")
    row = docs.agg(
        F.min(F.array_max("incident_dates")).alias("first"), F.max(F.array_max("incident_dates")).alias("last"),
        F.min(F.size("incident_dates")).alias("least"), F.count_distinct(F.split("beat_url", "/")[3]).alias("sites"), F.count("*").alias("n"),
    ).first()
    assert row.least >= 1 and row.first.year >= 1995 and row.last.year <= 2001
    assert row.sites == row.n == 1001


def test_tables_with_splits_enough_are_not_shuffled(spark, tmp_path):
    spark.range(1000).repartition(40).write.parquet(str(tmp_path / "many.parquet"))
    spark.range(1000).coalesce(1).write.parquet(str(tmp_path / "one.parquet"))
    spark.conf.set("spark.sql.files.openCostInBytes", "200m")
    try:
        plans = [inputs.costly(spark, str(tmp_path), n, "id")._jdf.queryExecution().executedPlan().toString() for n in ("many", "one")]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert "Exchange" not in plans[0] and "Exchange" in plans[1]


def test_many_short_rows_are_dealt_out(spark, tmp_path, monkeypatch):
    """Splits go by bytes; a split of many short rows is one long task of per-row work."""
    spark.range(2000).withColumn("text", F.lit("x")).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    monkeypatch.setattr(inputs, "ROWS_PER_TASK", 100)
    dealt = inputs.costly(spark, str(tmp_path), "t", "id", "text")
    sizes = [n for n in dealt.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    assert sum(sizes) == 2000 and max(sizes) <= 200
