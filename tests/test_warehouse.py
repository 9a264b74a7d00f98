from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from blotterflow import schemas as S
from blotterflow.operators import quality as Q
from blotterflow.operators.calendar import with_periods
from blotterflow.plans import warehouse as M
from blotterflow.plans.build import build_marts
from blotterflow.sources.tables import read_calendar

AT = datetime(2024, 12, 3)


def incident(key, kind, text, zone, source, *dates):
    ends = [date.fromisoformat(d) for d in dates] or [None]
    tier = "NONE" if zone == "UNKNOWN" else "HIGH"
    return (f"incident-{key}", f"u{key}", kind, text, zone, tier, source, False, ends[0], ends[-1])


@pytest.fixture(scope="module")
def store(spark):
    """Five incidents around a break that ends with a game on a Saturday."""
    incidents = [
        incident("p", "Welfare Check", "A resident did not answer calls.", "WYVIEW_WYMOUNT", "landmark", "2024-11-26"),
        incident("q", "Trespassing", "Two people were on a roof.", "UNKNOWN", "none", "2024-11-26"),
        incident("r", "Parking Complaint", "A truck blocked Lot 52.", "WYVIEW_WYMOUNT", "lot", "2024-11-30"),
        incident("s", "Fraud", "Tickets for the game were fake.", "OFF_CAMPUS", "landmark", "2024-11-30", "2024-12-01"),
        incident("t", "Chest Pain", "A guest felt unwell.", "OFF_CAMPUS", "landmark", "2024-12-01"),
    ]
    beats = [(f"u{k}", f" Police Beat {k} ", "", "x", AT) for k in "pqrst"]
    dates = [(i[0], i[8]) for i in incidents]
    return {
        "beats": spark.createDataFrame(beats, S.BEATS),
        "incidents": spark.createDataFrame(incidents, S.INCIDENTS),
        "incident_dates": spark.createDataFrame(dates, S.INCIDENT_DATES),
    }


@pytest.fixture(scope="module")
def tables(spark, store):
    staging = M.staging(store)
    seed = read_calendar(spark)
    return {**store, **staging, **M.marts(staging["stg_incidents"], seed), "academic_calendar": seed}


def test_calendar_seed(spark, tmp_path):
    seed = read_calendar(spark)
    counts = {r.period_type: r["count"] for r in seed.groupBy("period_type").count().collect()}
    assert counts == {"SEMESTER": 18, "FINALS": 18, "BREAK": 40, "GAME_DAY": 24}
    path = tmp_path / "c.csv"
    path.write_text("# note\nperiod_type,label,start_date,end_date\nBREAK,Rest,2024-01-01,2024-01-02\n")
    assert [tuple(r) for r in read_calendar(spark, str(path)).collect()] == [
        ("BREAK", "Rest", date(2024, 1, 1), date(2024, 1, 2))
    ]


def test_daily_summary(tables):
    rows = tables["mart_daily_summary"].orderBy("date_day").collect()
    assert [(r.date_day.month, r.date_day.day) for r in rows] == [(11, 26), (11, 27), (11, 28), (11, 29), (11, 30), (12, 1)]
    assert [r.total_incidents for r in rows] == [2, 0, 0, 0, 2, 1]
    assert [r.located_incidents for r in rows] == [1, 0, 0, 0, 2, 1]
    assert [r.distinct_zones for r in rows] == [1, 0, 0, 0, 2, 1]
    assert [r.is_break for r in rows] == [False, True, True, True, False, False]
    assert [r.is_game_day for r in rows] == [False] * 4 + [True, False]
    assert [r.is_weekend for r in rows] == [False] * 4 + [True, True]
    assert not any(r.is_finals for r in rows) and {r.semester for r in rows} == {"Fall Semester 2024"}


def test_dimensions(tables):
    types = {tuple(r) for r in tables["dim_incident_type"].collect()}
    assert types == {
        ("Welfare Check", "Service"), ("Trespassing", "Conduct/Crime"), ("Parking Complaint", "Traffic"),
        ("Fraud", "Property"), ("Chest Pain", "Medical"),
    }
    zones = {r.location_zone: tuple(r)[1:] for r in tables["dim_location"].collect()}
    assert set(zones) == {"UNKNOWN", "WYVIEW_WYMOUNT", "OFF_CAMPUS"}
    assert zones["UNKNOWN"] == ("Unknown", False, False, False, True)
    assert zones["WYVIEW_WYMOUNT"] == ("Wyview / Wymount", True, False, True, False)
    assert tables["fct_incidents"].agg(F.sum("incident_count")).first()[0] == 5
    assert {r.beat_title for r in tables["stg_beats"].collect()} == {f"Police Beat {k}" for k in "pqrst"}
    assert tables["stg_beats"].filter("published_at IS NOT NULL").count() == 0


def test_null_zone_and_type(spark):
    staged = M.stg_incidents(spark.createDataFrame([incident("x", " ", "t", None, None)], S.INCIDENTS))
    zone = M.dim_location(staged).first()
    assert tuple(zone) == (None, "Unknown", None, None, None, None)
    assert M.dim_incident_type(staged).count() == 0
    assert M.dim_date(staged, read_calendar(spark)).count() == 0


def test_overlapping_and_inverted_periods(spark):
    days = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 2, 3, 9)], "date_day date")
    periods = [
        ("SEMESTER", "Late", date(2024, 1, 2), date(2024, 1, 3)),
        ("SEMESTER", "Early", date(2024, 1, 1), date(2024, 1, 2)),
        ("FINALS", "f", date(2024, 1, 3), date(2024, 1, 3)),
        ("BREAK", "backwards", date(2024, 1, 9), date(2024, 1, 1)),
    ]
    got = with_periods(days, spark.createDataFrame(periods, S.CALENDAR)).orderBy("date_day").collect()
    assert [r.semester for r in got] == ["Early", "Early", "Late", None]
    assert [r.is_finals for r in got] == [False, False, True, False]
    assert not any(r.is_break for r in got)


def test_built_marts_equal_their_plans(spark, store, tables, tmp_path):
    built = build_marts(spark, M.stg_incidents(store["incidents"]), read_calendar(spark), str(tmp_path))
    assert set(built) == {"dim_date", "dim_location", "dim_incident_type", "fct_incidents", "mart_daily_summary"}
    for name, df in built.items():
        assert df.columns == tables[name].columns
        assert sorted(map(str, df.collect())) == sorted(map(str, tables[name].collect()))


def test_all_declared_checks_pass(tables):
    results = Q.run_suite(M.model_checks(tables)).collect()
    assert len(results) == 27 and sum(r.failures for r in results) == 0


def test_checks_find_failures(spark):
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    child = spark.createDataFrame([("a",), ("z",), ("z",), (None,), ("y",)], "k string")
    got = Q.run_suite(
        [
            Q.unique(child, "child", "k"),
            Q.not_null(child, "child", "k"),
            Q.accepted_values(child, "child", "k", ["a", "y"]),
            Q.relationship(child, "child", "k", parent, "k"),
        ]
    ).collect()
    assert {r.check_kind: r.failures for r in got} == {
        "unique": 1, "not_null": 1, "accepted_values": 1, "relationships": 3,
    }


def test_a_suite_scans_each_table_once(spark, tmp_path):
    spark.range(50).selectExpr("id", "id % 7 as k", "if(id = 3, null, id) as n", "'x' as set").write.parquet(str(tmp_path / "child"))
    spark.range(5).selectExpr("cast(id as int) as k").write.parquet(str(tmp_path / "parent"))
    child, parent = (spark.read.parquet(str(tmp_path / t)) for t in ("child", "parent"))
    checks = [
        Q.unique(child, "child", "id"), Q.unique(child, "child", "k"), Q.not_null(child, "child", "n"), Q.not_null(child, "child", "id"),
        Q.accepted_values(child, "child", "k", [0, 1, 2]), Q.accepted_values(child, "child", "set", ["x"]),
        Q.relationship(child, "child", "k", parent, "k"), Q.unique(parent, "parent", "k"), Q.relationship(parent, "parent", "k", child, "n"),
    ]
    suite = Q.run_suite(checks)
    assert [r.failures for r in suite.collect()] == [0, 7, 1, 0, 4, 0, 14, 0, 1]
    plan = suite._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 2
