"""Table scans and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotterflow.config import CALENDAR_CSV
from blotterflow.plans.ingest import flatten_for_csv
from blotterflow.schemas import CALENDAR, TABLES

MARTS = ("dim_date", "dim_location", "dim_incident_type", "fct_incidents", "mart_daily_summary")
# rows of one CSV file
ROWS_PER_CSV = 50_000
STORE_TABLES = ("beats", "incidents", "incident_dates")


def read_calendar(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The calendar seed, dates typed by schema; ``#`` lines are comments.

    Without a path the packaged seed is used. It is read on the driver, where
    the package is, because executors need not have the file.
    """
    if path is None:
        lines = CALENDAR_CSV.read_text(encoding="utf-8").splitlines()
        rows = [tuple(x.split(",")) for x in lines if not x.startswith("#")][1:]
        text = T.StructType([T.StructField(f.name, T.StringType()) for f in CALENDAR.fields])
        seed = spark.createDataFrame(rows, text)
        return seed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CALENDAR.fields])
    return spark.read.schema(CALENDAR).option("header", True).option("comment", "#").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header, UTF-8, quotes doubled, NULL and empty both written as nothing.

    Fields may hold line breaks, so a file is read back by one task: files are bounded.
    """
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("maxRecordsPerFile", ROWS_PER_CSV)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``write_csv`` wrote; nothing between two commas is NULL."""
    options = {"header": True, "encoding": "UTF-8", "quote": '"', "escape": '"', "multiLine": True}
    return spark.read.schema(schema).options(**options).csv(path)


def write_raw_csv(raw: DataFrame, path: str) -> None:
    """The flat snapshot of raw documents."""
    write_csv(flatten_for_csv(raw), path)


def write_explorer_csv(table: DataFrame, path: str) -> None:
    """The filtered explorer table."""
    write_csv(table, path)


def read_tables(
    spark: SparkSession, root: str, names: Iterable[str] = (*STORE_TABLES, *MARTS)
) -> dict[str, DataFrame]:
    """Written tables by name, with declared schemas and so without a job."""
    return {name: spark.read.schema(TABLES[name]).parquet(f"{root}/{name}") for name in names}


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Tables or staging plans as temporary views."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def write_facts(facts: DataFrame, path: str) -> None:
    """Facts laid out by day, so that date filters skip files.

    The range key ends with the incident id: a day with a large share of all
    facts is cut into several ranges instead of filling one task.
    """
    keys = ("occurred_date", "incident_id")
    facts.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)


def write_mart(df: DataFrame, root: str, name: str) -> None:
    """Full rebuild of one mart under ``root``."""
    if name == "fct_incidents":
        write_facts(df, f"{root}/{name}")
    else:
        df.write.mode("overwrite").parquet(f"{root}/{name}")


def save_marts(marts: Mapping[str, DataFrame], database: str = "analytics", location: str | None = None) -> None:
    """Full rebuild as catalog tables, in the warehouse or at a location of their own."""
    place = f" LOCATION '{location}'" if location else ""
    for name, df in marts.items():
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
        df.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")


def marts_exist(spark: SparkSession, database: str = "analytics") -> bool:
    """Has the fact table been built."""
    return spark.catalog.tableExists(f"{database}.fct_incidents")
