"""Explicit schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


STR, BOOL, DATE, INT, LONG = (
    T.StringType(), T.BooleanType(), T.DateType(), T.IntegerType(), T.LongType(),
)

PAGES = _struct(("url", STR), ("html", STR))

RAW_INCIDENTS = _struct(
    ("beat_url", STR),
    ("beat_title", STR),
    ("beat_published_at", STR),
    ("date_range_raw", STR),
    ("incident_dates", T.ArrayType(DATE)),
    ("is_multi_date_beat", BOOL),
    ("incident_type", STR),
    ("incident_text", STR),
    ("raw_text_hash", STR),
    ("scraped_at", T.TimestampType()),
    ("location_zone", STR),
    ("location_confidence", STR),
    ("location_source", STR),
    ("location_reasoning", STR),
    ("normalized", BOOL),
)

BEATS = _struct(
    ("beat_url", STR),
    ("beat_title", STR),
    ("published_at", STR),
    ("date_range_raw", STR),
    ("scraped_at", T.TimestampType()),
)

INCIDENTS = _struct(
    ("raw_text_hash", STR),
    ("beat_url", STR),
    ("incident_type", STR),
    ("incident_text", STR),
    ("location_zone", STR),
    ("location_confidence", STR),
    ("location_source", STR),
    ("is_multi_date_beat", BOOL),
    ("earliest_date", DATE),
    ("latest_date", DATE),
)

INCIDENT_DATES = _struct(("raw_text_hash", STR), ("incident_date", DATE))

CALENDAR = _struct(
    ("period_type", STR), ("label", STR), ("start_date", DATE), ("end_date", DATE)
)

# ---- marts ------------------------------------------------------------------
DIM_DATE = _struct(
    ("date_day", DATE),
    ("day_of_week", INT),
    ("day_name", STR),
    ("is_weekend", BOOL),
    ("semester", STR),
    ("is_finals", BOOL),
    ("is_break", BOOL),
    ("is_game_day", BOOL),
)

DIM_LOCATION = _struct(
    ("location_zone", STR),
    ("zone_label", STR),
    ("is_residential", BOOL),
    ("is_academic", BOOL),
    ("is_on_campus", BOOL),
    ("is_unknown", BOOL),
)

DIM_INCIDENT_TYPE = _struct(("incident_type", STR), ("incident_category", STR))

FCT_INCIDENTS = _struct(
    ("incident_id", STR),
    ("occurred_date", DATE),
    ("location_zone", STR),
    ("incident_type", STR),
    ("beat_url", STR),
    ("location_source", STR),
    ("location_confidence", STR),
    ("incident_text", STR),
    ("incident_count", INT),
)

DAILY_SUMMARY = _struct(
    ("date_day", DATE),
    ("day_name", STR),
    ("is_weekend", BOOL),
    ("semester", STR),
    ("is_finals", BOOL),
    ("is_break", BOOL),
    ("is_game_day", BOOL),
    ("total_incidents", LONG),
    ("located_incidents", LONG),
    ("distinct_zones", LONG),
)

TABLES = {
    "raw_incidents": RAW_INCIDENTS,
    "beats": BEATS,
    "incidents": INCIDENTS,
    "incident_dates": INCIDENT_DATES,
    "dim_date": DIM_DATE,
    "dim_location": DIM_LOCATION,
    "dim_incident_type": DIM_INCIDENT_TYPE,
    "fct_incidents": FCT_INCIDENTS,
    "mart_daily_summary": DAILY_SUMMARY,
}

# ---- what the HTML walk returns -------------------------------------------
# One row per page: its texts once, its containers as ranges of them.
PAGE_TEXTS = _struct(
    ("url", STR),
    ("layers", T.ArrayType(STR)),
    ("text", STR),
    ("paragraphs", T.ArrayType(_struct(("start", INT), ("length", INT)))),
    (
        "containers",
        T.ArrayType(
            _struct(
                ("candidate_no", INT),
                ("layer", INT),
                ("raw_start", INT),
                ("raw_length", INT),
                ("first_paragraph", INT),
                ("n_paragraphs", INT),
            )
        ),
    ),
)

LIST_PAGES = _struct(
    ("page_no", LONG),
    ("page_url", STR),
    ("next_page_url", STR),
    (
        "items",
        T.ArrayType(_struct(("url", STR), ("title", STR), ("published_at", STR))),
    ),
)
