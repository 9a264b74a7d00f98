"""Date column functions (T3-T5, T16, T17) and the day spine (O1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterflow.config import DATE_FORMAT, DATE_PATTERN, DEFAULT, PipelineConfig
from blotterflow.functions.text import collapse_ws


def date_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(DATE_PATTERN), F.lit(0))


def date_range(title: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """The text after the title separator, else the date tokens joined."""
    pattern = "(?iU)" + cfg.title_pattern
    return F.when(
        title.rlike(pattern), collapse_ws(F.regexp_extract(title, pattern, 1))
    ).otherwise(F.array_join(date_tokens(title), " - "))


def is_multi_date(range_text: Column) -> Column:
    """T5: more than one date token, valid or not."""
    return F.size(date_tokens(range_text)) > 1


def parsed_dates(range_text: Column) -> Column:
    """The valid dates of a range text; year 0000 is not a date."""
    days = F.transform(date_tokens(range_text), lambda t: F.try_to_date(t, DATE_FORMAT))
    return F.filter(days, lambda d: d.isNotNull() & (F.year(d) >= 1))


def expand_dates(days: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """T4 on parsed dates: every day from first to last; ends only if too wide."""
    first, last = F.array_min(days), F.array_max(days)
    return (
        F.when(F.size(days) == 0, F.array().cast("array<date>"))
        .when(F.date_diff(last, first) > cfg.max_span_days, F.array(first, last))
        .otherwise(F.sequence(first, last))
    )


def with_candidate_dates(
    df: DataFrame, range_col: str = "date_range_raw", out: str = "incident_dates",
    cfg: PipelineConfig = DEFAULT,
) -> DataFrame:
    """T4 as a column; the tokens are parsed once per row."""
    return (
        df.withColumn("_days", parsed_dates(F.col(range_col)))
        .withColumn(out, expand_dates(F.col("_days"), cfg))
        .drop("_days")
    )


def occurred_date(earliest: Column, latest: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """The later end when the span is implausible, else the earlier."""
    return F.when(F.date_diff(latest, earliest) > cfg.max_span_days, latest).otherwise(earliest)


def day_of_week(day: Column) -> Column:
    return F.extract(F.lit("DAYOFWEEK_ISO"), day).cast("int")


def day_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def calendar_attrs(day: Column) -> list[Column]:
    """ISO weekday number, English name, weekend flag."""
    return [
        day_of_week(day).alias("day_of_week"),
        day_name(day).alias("day_name"),
        day_of_week(day).isin(6, 7).alias("is_weekend"),
    ]


def spine(bounds: DataFrame, first: str = "min_date", last: str = "max_date") -> DataFrame:
    """O1: one row per day of a one-row bounds frame; no rows for NULL bounds.

    The DATE type itself bounds the spine at 3.65 million days, whatever the
    size of the facts it was measured on.
    """
    return bounds.select(F.explode(F.sequence(first, last)).alias("date_day"))
