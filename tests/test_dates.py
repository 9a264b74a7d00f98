from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from blotterflow.functions import dates as D


def test_range_from_title(apply):
    cases = {
        "Police Beat • 02/28/2023": "02/28/2023",
        "Police Beat - 11/08/2024 - 11/10/2024": "11/08/2024 - 11/10/2024",
        "POLICE   BEAT: first  week": "first week",
        "Police Beat 04/30/2021 05/01/2021": "04/30/2021 - 05/01/2021",
        "Police Beat": "",
        "Weekly Police Beat - a - b": "a - b",
    }
    assert apply(list(cases), D.date_range) == list(cases.values())


def test_multi_date_counts_tokens(apply):
    cases = {"06/01/2026": False, "06/01/2026 06/01/2026": True, "99/99/2026 - 06/01/2026": True, "": False}
    assert apply(list(cases), D.is_multi_date) == list(cases.values())


def _span(first: date, days: int):
    return [first + timedelta(days=i) for i in range(days)]


def test_candidate_dates(spark):
    cases = {
        "06/01/2026 - 06/03/2026": _span(date(2026, 6, 1), 3),
        "06/03/2026 - 06/01/2026": _span(date(2026, 6, 1), 3),
        "03/14/2024 - 03/16/2014": [date(2014, 3, 16), date(2024, 3, 14)],
        "08/30/20193 to 09/01/2019": _span(date(2019, 8, 30), 3),
        "05/05/20184 to 05/06/2021": [date(2018, 5, 5), date(2021, 5, 6)],
        "13/45/2023": [],
        "02/30/2024 - 03/01/2024": [date(2024, 3, 1)],
        "01/01/0000": [],
        "01/01/2024 - 02/01/2024": _span(date(2024, 1, 1), 32),
        "01/01/2024 - 02/02/2024": [date(2024, 1, 1), date(2024, 2, 2)],
        "01/01/2024 01/01/2024": [date(2024, 1, 1)],
        "": [],
    }
    df = spark.createDataFrame([(k,) for k in cases], "date_range_raw string")
    got = {r.date_range_raw: r.incident_dates for r in D.with_candidate_dates(df).collect()}
    assert got == cases


def test_occurred_date_repairs_wide_spans(spark):
    rows = [
        (date(2014, 3, 16), date(2024, 3, 14), date(2024, 3, 14)),
        (date(2024, 1, 1), date(2024, 2, 1), date(2024, 1, 1)),
        (date(2024, 1, 1), date(2024, 2, 2), date(2024, 2, 2)),
        (None, None, None),
        (date(2024, 1, 1), None, date(2024, 1, 1)),
    ]
    df = spark.createDataFrame(rows, "a date, b date, want date")
    got = df.select("want", D.occurred_date(F.col("a"), F.col("b")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(date(2026, 6, d),) for d in (15, 20, 21)], "d date")
    got = [tuple(r) for r in df.orderBy("d").select(*D.calendar_attrs(F.col("d"))).collect()]
    assert got == [(1, "Monday", False), (6, "Saturday", True), (7, "Sunday", True)]


def test_spine(spark):
    bounds = spark.createDataFrame([(date(2026, 2, 27), date(2026, 3, 1))], "min_date date, max_date date")
    assert [r.date_day for r in D.spine(bounds).collect()] == _span(date(2026, 2, 27), 3)
    empty = spark.createDataFrame([(None, None)], "min_date date, max_date date")
    assert D.spine(empty).collect() == []
