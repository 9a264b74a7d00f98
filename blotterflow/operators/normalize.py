"""Raw documents to relational rows (N1-N4, N8) and new table states."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterflow.functions.text import empty_to_null
from blotterflow.operators.caps import among_first
from blotterflow.operators.dedup import last_seen, replace_children, upsert

# which of several writes of one key is the last, with no ties left
BEAT_ORDER = ("scraped_at", "beat_title", "date_range_raw", "published_at")
DOCUMENT_ORDER = (
    "scraped_at", "beat_title", "date_range_raw", "beat_published_at", "location_zone", "location_source",
)


def is_ready() -> Column:
    """Classified and not yet normalized."""
    return ~F.col("normalized") & F.col("location_zone").isNotNull()


def ready_documents(raw: DataFrame, limit: int | None = None, key: str = "raw_text_hash") -> DataFrame:
    """The documents to normalize; capped, all documents of the first keys.

    Whole keys are taken, because N8 raises the flag for a key.
    """
    ready = raw.filter(is_ready())
    return ready if limit is None else ready.filter(among_first(ready, key, limit))


def real_dates(dates: Column) -> Column:
    """The non-blank candidate dates; accepts ISO strings or dates."""
    return F.filter(dates.cast("array<string>"), lambda d: d.isNotNull() & (d != "")).cast("array<date>")


def to_beats(raw: DataFrame, *kept: str) -> DataFrame:
    """One row per document, with the columns ``kept``; N5 reduces them to one per page."""
    return raw.select(
        "beat_url",
        "beat_title",
        empty_to_null(F.col("beat_published_at")).alias("published_at"),
        "date_range_raw",
        "scraped_at",
        *kept,
    )


def to_incidents(raw: DataFrame) -> DataFrame:
    """Span ends from the candidate dates; the reasoning is left behind."""
    return raw.withColumn("_dates", real_dates(F.col("incident_dates"))).select(
        "raw_text_hash",
        "beat_url",
        "incident_type",
        "incident_text",
        "location_zone",
        "location_confidence",
        "location_source",
        F.coalesce("is_multi_date_beat", F.lit(False)).alias("is_multi_date_beat"),
        F.array_min("_dates").alias("earliest_date"),
        F.array_max("_dates").alias("latest_date"),
    )


def to_dates(raw: DataFrame) -> DataFrame:
    """One row per incident and distinct candidate date."""
    return raw.select(
        "raw_text_hash",
        F.explode(F.array_distinct(real_dates(F.col("incident_dates")))).alias("incident_date"),
    )


def mark_normalized(raw: DataFrame, written: DataFrame, key: str = "raw_text_hash") -> DataFrame:
    """Raises the flag of every written document."""
    flags = written.select(key).distinct().withColumn("_written", F.lit(True))
    flag = F.coalesce("_written", F.col("normalized"))
    return raw.join(flags, key, "left").withColumn("normalized", flag).select(*raw.columns)


def normalize_pending(
    raw: DataFrame, tables: Mapping[str, DataFrame], limit: int | None = None
) -> dict[str, DataFrame]:
    """N1-N8 as plans: the new state of the clean tables and of the raw table.

    Write the clean tables first and ``raw_incidents`` last. A run that dies in
    between is repeated by the next one, which upserts the same rows again.
    """
    ready = ready_documents(raw, limit)
    documents = last_seen(ready, ["raw_text_hash"], DOCUMENT_ORDER)
    incidents, dates = to_incidents(documents), to_dates(documents)
    return {
        "beats": upsert(tables["beats"], to_beats(ready), "beat_url", BEAT_ORDER),
        "incidents": upsert(tables["incidents"], incidents, "raw_text_hash", ["beat_url"]),
        "incident_dates": replace_children(
            tables["incident_dates"], dates, documents, "raw_text_hash"
        ),
        "raw_incidents": mark_normalized(raw, documents),
    }
