from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from blotterflow.config import DEFAULT
from blotterflow.plans import serving as V

DETAIL = (
    "date date, zone string, zone_unknown boolean, category string, type string, narrative string, semester string, "
    "is_finals boolean, is_break boolean, is_game_day boolean, is_weekend boolean"
)
SPINE = "date_day date, semester string, is_finals boolean, is_break boolean, is_game_day boolean, is_weekend boolean"
FIRST = date(2024, 1, 1)


def row(day, zone="Academic Core", category="Property", narrative="A bike.", semester="Winter"):
    when = None if day is None else FIRST + timedelta(days=day)
    return (when, zone, zone == "Unknown", category, "Theft", narrative, semester, False, False, False, False)


def spine_row(day, finals=False, rest=False, game=False):
    return (FIRST + timedelta(days=day), "Winter", finals, rest, game, False)


@pytest.fixture(scope="module")
def detail(spark):
    rows = [row(0)] * 3 + [row(2, "Unknown")] * 6 + [row(None, "Off Campus", "Other", "LOT [5]", None), row(3, narrative=None)]
    return spark.createDataFrame(rows, DETAIL)


@pytest.fixture(scope="module")
def spine(spark):
    rows = [spine_row(0, finals=True, rest=True), spine_row(1, rest=True, game=True), spine_row(2), spine_row(3, game=True)]
    return spark.createDataFrame(rows, SPINE)


def test_outlier_days_are_strictly_above_the_threshold(detail, spine):
    cfg = replace(DEFAULT, outlier_day_threshold=5)
    daily = detail.filter("date IS NOT NULL").groupBy(F.col("date").alias("date_day")).agg(F.count("*").alias("total_incidents"))
    days = V.outlier_days(daily, cfg)
    assert [r.date.day for r in days.collect()] == [3]
    assert V.outlier_days(daily, replace(DEFAULT, outlier_day_threshold=6)).count() == 0
    kept, kept_spine = V.without_outliers(detail, spine, days)
    assert kept.count() == 5 and kept.filter("date IS NULL").count() == 1
    assert kept_spine.count() == 3


def test_filters(detail):
    end = FIRST + timedelta(days=1)
    assert V.filter_incidents(detail, FIRST, end).count() == 4  # undated rows stay
    assert V.filter_incidents(detail, semesters=["Winter"]).count() == 10
    assert V.filter_incidents(detail, zones=["Unknown", "Off Campus"]).count() == 7
    assert V.filter_incidents(detail, categories=["Other"]).count() == 1
    assert V.filter_incidents(detail).count() == 11


def test_search_is_a_pattern_unless_literal(detail):
    assert V.filter_incidents(detail, search="BIKE|lot").count() == 10
    assert V.filter_incidents(detail, search="[5]").count() == 1
    assert V.filter_incidents(detail, search="lot [5]").count() == 0
    assert V.filter_incidents(detail, search="lot [5]", literal=True).count() == 1


def test_headline(detail, spine):
    got = V.headline(detail, spine).first()
    assert (got.incidents, got.incidents_per_day, got.zones) == (11, 11 / 4, 2)
    empty = V.headline(detail.limit(0), spine.limit(0)).first()
    assert (empty.incidents, empty.incidents_per_day, empty.zones) == (0, 0.0, 0)


def test_trend(detail, spine):
    rows = V.daily_trend(detail, spine).orderBy("date_day").collect()
    assert [r.incidents for r in rows] == [3, 0, 6, 1]
    assert [r.rolling for r in rows] == [3.0, 1.5, 3.0, 2.5]
    assert [r.day_type for r in rows] == ["Finals", "Break", "Regular", "Game day"]


def test_rolling_mean_counts_rows_not_days(spark):
    days = [(FIRST + timedelta(days=30 * i), i) for i in range(9)]
    df = spark.createDataFrame(days, "date_day date, incidents int")
    got = [r.rolling for r in V.rolling_mean(df).orderBy("date_day").collect()]
    assert got == [0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 4.0, 5.0]


def test_half_even(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (2.5,), (1.005,)], "x double")
    assert [r[0] for r in df.select(V.half_even(F.col("x"))).collect()] == [0.12, 0.38, 2.5, 1.0]


def test_calendar_effect(detail, spine):
    got = [tuple(r) for r in V.calendar_effect(detail, spine).collect()]
    assert got == [("Regular", 6.0, 1, 6), ("Finals", 3.0, 1, 3), ("Break", 0.0, 1, 0), ("Game day", 1.0, 1, 1)]


def test_breakdowns(detail):
    assert [tuple(r) for r in V.by_zone(detail).collect()] == [("Academic Core", 4), ("Off Campus", 1)]
    assert [tuple(r) for r in V.by_category(detail).collect()] == [("Property", 10), ("Other", 1)]
    assert {tuple(r) for r in V.zone_category_grid(detail).collect()} == {
        ("Academic Core", "Property", 4), ("Off Campus", "Other", 1),
    }


def test_weekdays(detail):
    got = [tuple(r) for r in V.weekday_profile(detail).collect()]
    assert got == [
        ("Monday", 3), ("Tuesday", 0), ("Wednesday", 6), ("Thursday", 1), ("Friday", 0), ("Saturday", 0), ("Sunday", 0),
    ]
    assert V.weekday_profile(detail.filter("date IS NULL")).count() == 0


def test_options(detail, spine):
    got = [tuple(r) for r in V.filter_options(detail).collect()]
    assert got == [
        ("category", "Other"), ("category", "Property"), ("semester", "Winter"),
        ("zone", "Academic Core"), ("zone", "Off Campus"), ("zone", "Unknown"),
    ]
    assert tuple(V.spine_bounds(spine).first()) == (FIRST, FIRST + timedelta(days=3))


def test_explorer(detail):
    table = V.explorer(detail)
    assert table.columns == ["Date", "Zone", "Category", "Type", "Narrative"]
    dates = [r.Date for r in table.collect()]
    assert dates[-1] is None and dates[:-1] == sorted(dates[:-1], reverse=True)
    assert tuple(V.match_counts(detail.limit(4), detail).first()) == (4, 11)


def test_detail_joins_only_what_it_needs(spark):
    facts = spark.createDataFrame(
        [("1", FIRST, "MTC", "Theft", "n"), ("2", None, "UNKNOWN", None, "m"), ("3", FIRST, None, "Theft", "k")],
        "incident_id string, occurred_date date, location_zone string, incident_type string, incident_text string",
    )
    t = {
        "fct_incidents": facts,
        "dim_location": spark.createDataFrame(
            [("MTC", "Center", False), ("UNKNOWN", "Unknown", True)], "location_zone string, zone_label string, is_unknown boolean"
        ),
        "dim_incident_type": spark.createDataFrame([("Theft", "Property")], "incident_type string, incident_category string"),
        "dim_date": spark.createDataFrame([spine_row(0, finals=True)], SPINE),
    }
    rows = {r.narrative: r for r in V.incident_detail(t).collect()}
    assert set(rows) == {"n", "m"}
    assert (rows["n"].category, rows["n"].is_finals, rows["n"].semester) == ("Property", True, "Winter")
    assert (rows["m"].category, rows["m"].is_finals, rows["m"].semester) == ("Uncategorized", False, None)
    narrow = V.incident_detail(t, ["date", "zone"])
    assert narrow.columns == ["date", "zone"] and narrow.count() == 2
    newest = V.newest_first(V.incident_detail(t)).collect()
    assert [r.date for r in newest] == [FIRST, None]


def test_newest_first_is_one_order_whatever_the_partitions(spark):
    days = [FIRST, None]
    rows = [(f"i{n:03}", days[n % 2], "MTC", "Theft", f"text {n}") for n in range(200)]
    t = {
        "dim_location": spark.createDataFrame([("MTC", "Center", False)], "location_zone string, zone_label string, is_unknown boolean"),
        "dim_incident_type": spark.createDataFrame([("Theft", "Property")], "incident_type string, incident_category string"),
        "dim_date": spark.createDataFrame([spine_row(0)], SPINE),
    }
    schema = "incident_id string, occurred_date date, location_zone string, incident_type string, incident_text string"
    seen = []
    for n in (1, 3, 8):
        facts = spark.createDataFrame(rows, schema).repartition(n, F.rand(n))
        detail = V.incident_detail({**t, "fct_incidents": facts}, (*V.DETAIL_COLUMNS, V.ROW_ID))
        shown = V.newest_first(detail)
        assert tuple(shown.columns) == V.DETAIL_COLUMNS
        seen.append([r.narrative for r in shown.collect()])
        assert seen[-1] == [r.Narrative for r in V.explorer(detail).collect()]
    assert seen[0] == seen[1] == seen[2] == [f"text {n}" for n in (*range(0, 200, 2), *range(1, 200, 2))]
