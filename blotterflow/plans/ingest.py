"""Pages to raw documents (T14) and their flat export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterflow.config import CSV_COLUMNS, DEFAULT, PipelineConfig
from blotterflow.functions.dates import date_range, is_multi_date, with_candidate_dates
from blotterflow.functions.text import incident_hash
from blotterflow.operators.dedup import first_seen
from blotterflow.operators.segment import best_candidate, container_incidents, unfold
from blotterflow.schemas import RAW_INCIDENTS
from blotterflow.sources.html_pages import extract_containers, extract_list_items


def report_summaries(list_pages: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """The reports of all list pages, each URL once, in page order."""
    items = extract_list_items(list_pages, cfg)
    return first_seen(items, ["url"], ["page_no", "item_no"]).drop("next_page_url")


def page_incidents(pages: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """One row per page with its incidents; pages hold each URL once."""
    return best_candidate(container_incidents(extract_containers(pages, cfg), cfg))


def with_title_dates(df: DataFrame, title: str = "title", cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """T3-T5 from a title column."""
    ranged = df.withColumn("date_range_raw", date_range(F.col(title), cfg)).withColumn(
        "is_multi_date_beat", is_multi_date(F.col("date_range_raw"))
    )
    return with_candidate_dates(ranged, cfg=cfg)


def as_raw_document(df: DataFrame) -> DataFrame:
    """Hash and placeholders; column order of the landing table."""
    blank = {
        "location_zone": "string",
        "location_confidence": "string",
        "location_source": "string",
        "location_reasoning": "string",
    }
    return (
        df.withColumn(
            "raw_text_hash",
            incident_hash(F.col("beat_url"), F.col("incident_type"), F.col("incident_text")),
        )
        .withColumns({name: F.lit(None).cast(kind) for name, kind in blank.items()})
        .withColumn("normalized", F.lit(False))
        .select(*RAW_INCIDENTS.fieldNames())
    )


def assemble_raw(
    summaries: DataFrame, best: DataFrame, scraped_at: Column, cfg: PipelineConfig = DEFAULT
) -> DataFrame:
    """Each incident with its report's title fields.

    Pages join summaries while each is still one row; incidents are unfolded
    after the join, so dates are worked out per report, not per incident.
    """
    titled = with_title_dates(summaries.select("url", "title", "published_at"), cfg=cfg)
    joined = titled.join(best.select("url", "incidents"), "url")
    rows = joined.select(
        F.col("url").alias("beat_url"),
        F.col("title").alias("beat_title"),
        F.col("published_at").alias("beat_published_at"),
        "date_range_raw",
        "incident_dates",
        "is_multi_date_beat",
        "incidents",
    )
    return as_raw_document(
        unfold(rows, "incidents", "incident_no", "incident")
        .withColumn("incident_type", F.col("incident.incident_type"))
        .withColumn("incident_text", F.col("incident.incident_text"))
        .withColumn("scraped_at", scraped_at)
    )


def raw_from_pages(
    list_pages: DataFrame,
    detail_pages: DataFrame,
    scraped_at: Column,
    cfg: PipelineConfig = DEFAULT,
) -> DataFrame:
    """Fetched list and report pages to raw documents."""
    return assemble_raw(
        report_summaries(list_pages, cfg), page_incidents(detail_pages, cfg), scraped_at, cfg
    )


def flatten_for_csv(raw: DataFrame) -> DataFrame:
    """Ten string columns; dates joined by ``;``, time in ISO form."""
    stamp = F.date_format("scraped_at", "yyyy-MM-dd'T'HH:mm:ssxxx")
    special = {
        "incident_dates": F.array_join(F.col("incident_dates").cast("array<string>"), ";"),
        "is_multi_date_beat": F.col("is_multi_date_beat").cast("string"),
        "scraped_at": stamp,
    }
    return raw.select(*[special.get(c, F.col(c)).alias(c) for c in CSV_COLUMNS])
