"""Full rebuild of the marts as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotterflow.config import DEFAULT, PipelineConfig
from blotterflow.plans import warehouse as M
from blotterflow.sources.tables import read_tables, write_mart


def build_marts(
    spark: SparkSession,
    staged: DataFrame,
    calendar: DataFrame,
    root: str,
    cfg: PipelineConfig = DEFAULT,
) -> dict[str, DataFrame]:
    """Write the five marts under ``root`` and return them as tables.

    The daily summary is built from the written days and facts, so staged
    incidents are not worked through again for it.
    """
    plans = M.marts(staged, calendar, cfg)
    for name in ("dim_date", "dim_location", "dim_incident_type", "fct_incidents"):
        write_mart(plans[name], root, name)
    built = read_tables(spark, root, ("dim_date", "fct_incidents"))
    daily = M.daily_summary(built["dim_date"], built["fct_incidents"])
    write_mart(daily, root, "mart_daily_summary")
    return read_tables(spark, root, plans)
