from __future__ import annotations

import csv
from datetime import date, datetime
from pathlib import Path

from blotterflow import schemas as S
from blotterflow.sources import tables as TB


def read_csv(folder):
    out = []
    for part in sorted(Path(folder).glob("part-*.csv")):
        with open(part, encoding="utf-8", newline="") as handle:
            out += list(csv.DictReader(handle))
    return out


def test_flat_csv(spark, tmp_path):
    row = (
        "u", 'A "b", c', "", "r", [date(2024, 1, 1), date(2024, 1, 2)], True, " Théft", "x\ny", "h",
        datetime(2024, 2, 3, 4, 5, 6), None, None, None, None, False,
    )
    path = str(tmp_path / "flat")
    TB.write_raw_csv(spark.createDataFrame([row], S.RAW_INCIDENTS).coalesce(1), path)
    assert read_csv(path) == [
        {
            "beat_url": "u",
            "beat_title": 'A "b", c',
            "beat_published_at": "",
            "date_range_raw": "r",
            "incident_dates": "2024-01-01;2024-01-02",
            "is_multi_date_beat": "true",
            "incident_type": " Théft",
            "incident_text": "x\ny",
            "raw_text_hash": "h",
            "scraped_at": "2024-02-03T04:05:06+00:00",
        }
    ]


def test_explorer_csv(spark, tmp_path):
    df = spark.createDataFrame([(date(2024, 1, 1), None)], "Date date, Zone string")
    TB.write_explorer_csv(df.coalesce(1), str(tmp_path / "x"))
    assert read_csv(tmp_path / "x") == [{"Date": "2024-01-01", "Zone": ""}]


def test_marts_in_catalog_and_as_views(spark):
    facts = spark.createDataFrame([("a", 1)], "incident_id string, n int")
    assert not TB.marts_exist(spark, "analytics_t")
    TB.save_marts({"fct_incidents": facts}, "analytics_t")
    TB.save_marts({"fct_incidents": facts}, "analytics_t")
    assert TB.marts_exist(spark, "analytics_t")
    assert spark.table("analytics_t.fct_incidents").count() == 1
    TB.register_views({"stg_x": facts})
    assert spark.sql("SELECT count(*) FROM stg_x").first()[0] == 1
    spark.sql("DROP DATABASE analytics_t CASCADE")


def test_facts_are_laid_out_by_day(spark, tmp_path):
    rows = [(f"{i:03}", date(2024, 1, 1 + i % 20)) for i in range(400)]
    facts = spark.createDataFrame(rows, "incident_id string, occurred_date date")
    # a table this small would be coalesced into one range
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    TB.write_facts(facts, str(tmp_path / "f"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ranges = []
    for part in Path(tmp_path / "f").glob("part-*.parquet"):
        days = [r.occurred_date for r in spark.read.parquet(str(part)).collect()]
        ranges.append((min(days), max(days)))
        assert days == sorted(days)
    ranges.sort()
    assert len(ranges) > 1 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))


def test_csv_files_are_bounded(spark, tmp_path):
    """A file is read back by one task, since fields may hold line breaks."""
    n = 2 * TB.ROWS_PER_CSV + 1
    rows = spark.range(n).selectExpr("id", "concat('a\n', id) AS text").coalesce(1)
    TB.write_csv(rows, str(tmp_path / "flat"))
    back = TB.read_csv(spark, str(tmp_path / "flat"), rows.schema)
    files = [r["count"] for r in back.groupBy("_metadata.file_path").count().collect()]
    assert len(files) == 3 and max(files) <= TB.ROWS_PER_CSV
    assert back.distinct().count() == n and back.where("text = concat('a\n', id)").count() == n
