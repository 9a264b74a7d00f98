"""Star-schema models over the clean store (M1-M8)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotterflow.config import DEFAULT, PERIOD_TYPES, UNKNOWN, PipelineConfig
from blotterflow.functions.dates import calendar_attrs, occurred_date, spine
from blotterflow.functions.rules import category, zone_attributes
from blotterflow.functions.text import blank_to_null
from blotterflow.operators import quality as Q
from blotterflow.operators.calendar import with_periods


def stg_beats(beats: DataFrame) -> DataFrame:
    """M1."""
    return beats.select(
        "beat_url",
        blank_to_null(F.col("beat_title")).alias("beat_title"),
        blank_to_null(F.col("published_at")).alias("published_at"),
        "date_range_raw",
        "scraped_at",
    )


def stg_incidents(incidents: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """M2: cleaned incidents with one best date each."""
    return incidents.select(
        F.col("raw_text_hash").alias("incident_id"),
        "beat_url",
        blank_to_null(F.col("incident_type")).alias("incident_type"),
        "incident_text",
        "location_zone",
        "location_confidence",
        "location_source",
        "is_multi_date_beat",
        "earliest_date",
        "latest_date",
        occurred_date(F.col("earliest_date"), F.col("latest_date"), cfg).alias("occurred_date"),
    )


def stg_incident_dates(incident_dates: DataFrame) -> DataFrame:
    """M3."""
    return incident_dates.select(F.col("raw_text_hash").alias("incident_id"), "incident_date")


def date_bounds(staged: DataFrame) -> DataFrame:
    """A1: first and last dated day, NULL if none."""
    return staged.agg(
        F.min("occurred_date").alias("min_date"), F.max("occurred_date").alias("max_date")
    )


def dim_date(staged: DataFrame, calendar: DataFrame) -> DataFrame:
    """M4: every day from first to last with its calendar context."""
    days = spine(date_bounds(staged)).select("date_day", *calendar_attrs(F.col("date_day")))
    return with_periods(days, calendar)


def dim_location(staged: DataFrame) -> DataFrame:
    """M5: observed zones with label and groupings."""
    zones = staged.select("location_zone").distinct()
    return zones.select("location_zone", *zone_attributes(F.col("location_zone")))


def dim_incident_type(staged: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """M6: observed types with their category."""
    types = staged.select("incident_type").filter(F.col("incident_type").isNotNull()).distinct()
    return types.select("incident_type", category(F.col("incident_type"), cfg).alias("incident_category"))


def fct_incidents(staged: DataFrame) -> DataFrame:
    """M7: one row per incident."""
    return staged.select(
        "incident_id",
        "occurred_date",
        "location_zone",
        "incident_type",
        "beat_url",
        "location_source",
        "location_confidence",
        "incident_text",
        F.lit(1).alias("incident_count"),
    )


def daily_summary(days: DataFrame, facts: DataFrame) -> DataFrame:
    """Counts per spine day; days without incidents give zeros.

    Facts are reduced to one row per day before they meet the spine, so the
    join is day by day and a crowded day is combined on the map side.
    """
    located = F.col("location_zone") != UNKNOWN
    per_day = (
        facts.filter(F.col("occurred_date").isNotNull())
        .groupBy(F.col("occurred_date").alias("date_day"))
        .agg(
            F.count("incident_id").alias("total_incidents"),
            F.count(F.when(located, F.col("incident_id"))).alias("located_incidents"),
            F.count_distinct(F.when(located, F.col("location_zone"))).alias("distinct_zones"),
        )
    )
    return days.join(per_day, "date_day", "left").select(
        "date_day",
        "day_name",
        "is_weekend",
        "semester",
        "is_finals",
        "is_break",
        "is_game_day",
        *[
            F.coalesce(c, F.lit(0)).alias(c)
            for c in ("total_incidents", "located_incidents", "distinct_zones")
        ],
    )


def staging(store: Mapping[str, DataFrame], cfg: PipelineConfig = DEFAULT) -> dict[str, DataFrame]:
    """The staging views over ``beats``, ``incidents`` and ``incident_dates``."""
    return {
        "stg_beats": stg_beats(store["beats"]),
        "stg_incidents": stg_incidents(store["incidents"], cfg),
        "stg_incident_dates": stg_incident_dates(store["incident_dates"]),
    }


def marts(
    staged: DataFrame, calendar: DataFrame, cfg: PipelineConfig = DEFAULT
) -> dict[str, DataFrame]:
    """The five marts as plans over staged incidents."""
    days, facts = dim_date(staged, calendar), fct_incidents(staged)
    return {
        "dim_date": days,
        "dim_location": dim_location(staged),
        "dim_incident_type": dim_incident_type(staged, cfg),
        "fct_incidents": facts,
        "mart_daily_summary": daily_summary(days, facts),
    }


def model_checks(t: Mapping[str, DataFrame], cfg: PipelineConfig = DEFAULT) -> list[Q.Check]:
    """The 27 declared checks over store, staging, seed and marts."""
    keys = (
        ("beats", "beat_url"),
        ("incidents", "raw_text_hash"),
        ("stg_incidents", "incident_id"),
        ("stg_beats", "beat_url"),
        ("dim_date", "date_day"),
        ("dim_location", "location_zone"),
        ("dim_incident_type", "incident_type"),
        ("fct_incidents", "incident_id"),
        ("mart_daily_summary", "date_day"),
    )
    links = (
        ("stg_incidents", "beat_url", "stg_beats", "beat_url"),
        ("stg_incident_dates", "incident_id", "stg_incidents", "incident_id"),
        ("fct_incidents", "location_zone", "dim_location", "location_zone"),
        ("fct_incidents", "incident_type", "dim_incident_type", "incident_type"),
        ("fct_incidents", "occurred_date", "dim_date", "date_day"),
    )
    return [
        *[Q.unique(t[name], name, column) for name, column in keys],
        *[Q.not_null(t[name], name, column) for name, column in keys],
        Q.not_null(t["academic_calendar"], "academic_calendar", "start_date"),
        Q.not_null(t["academic_calendar"], "academic_calendar", "end_date"),
        Q.accepted_values(t["stg_incidents"], "stg_incidents", "location_zone", cfg.zones),
        Q.accepted_values(t["academic_calendar"], "academic_calendar", "period_type", PERIOD_TYPES),
        *[Q.relationship(t[child], child, column, t[parent], key) for child, column, parent, key in links],
    ]
