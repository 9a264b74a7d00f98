"""Report queries over the marts.

Dimensions carry no broadcast hint. Read from mart tables their size is known,
and Spark broadcasts a small one by itself; a large one is sort-merge joined,
with AQE splitting hot keys of the fact side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotterflow.config import DAY_TYPES, DEFAULT, WEEKDAYS, PipelineConfig
from blotterflow.functions.dates import day_name
from blotterflow.operators.calendar import day_type

FLAGS = ("is_finals", "is_break", "is_game_day", "is_weekend")
EXPLORER_COLUMNS = ("date", "zone", "category", "type", "narrative")


DETAIL_COLUMNS = (
    "date", "zone", "zone_unknown", "category", "type", "narrative", "semester", *FLAGS,
)
# given on demand: what tells the rows of a day apart
ROW_ID = "incident_id"


def incident_detail(
    t: Mapping[str, DataFrame], columns: Sequence[str] = DETAIL_COLUMNS
) -> DataFrame:
    """Facts with their dimensions; a NULL zone drops the row.

    Only dimensions that give one of ``columns`` are joined. Spark cannot drop
    an unused left join itself, as it does not know the dimension keys to be
    unique.
    """
    dated = [c for c in ("semester", *FLAGS) if c in columns]
    out = t["fct_incidents"].join(
        t["dim_location"].select("location_zone", "zone_label", "is_unknown"), "location_zone"
    )
    if "category" in columns:
        out = out.join(t["dim_incident_type"], "incident_type", "left")
    if dated:
        days = t["dim_date"].select(F.col("date_day").alias("occurred_date"), *dated)
        out = out.join(days, "occurred_date", "left")
    source = {
        "date": F.col("occurred_date"),
        "zone": F.col("zone_label"),
        "zone_unknown": F.col("is_unknown"),
        "category": F.coalesce(F.col("incident_category"), F.lit("Uncategorized")),
        "type": F.col("incident_type"),
        "narrative": F.col("incident_text"),
        "semester": F.col("semester"),
        **{flag: F.coalesce(F.col(flag), F.lit(False)) for flag in FLAGS},
        ROW_ID: F.col(ROW_ID),
    }
    return out.select(*[source[c].alias(c) for c in (*DETAIL_COLUMNS, ROW_ID) if c in columns])


def half_even(c: Column, digits: int = 2) -> Column:
    """Scale, round to the even neighbour, scale back, in double arithmetic."""
    return F.rint(c * 10**digits) / 10**digits


def newest_first(detail: DataFrame, *keys: str) -> DataFrame:
    """O2: newest first, undated last; within a day by incident, whose id is dropped.

    Date and id are unique together, so the order is the same in every run, and they
    are narrow: sort keys are sampled and compared. Without the id, short columns settle ties as far
    as they can.
    """
    if ROW_ID in detail.columns and not keys:
        return detail.orderBy(F.desc_nulls_last("date"), ROW_ID).drop(ROW_ID)
    rest = keys or tuple(c for c in ("zone", "category", "type") if c in detail.columns)
    return detail.orderBy(F.desc_nulls_last("date"), *rest)


def date_spine(daily: DataFrame) -> DataFrame:
    """V2, O3: every calendar day with its context, in order."""
    return daily.select("date_day", "semester", *FLAGS).orderBy("date_day")


def outlier_days(daily: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """A4: days with more incidents than the threshold, from the daily summary.

    The summary counts a day's incidents already, one row per day.
    """
    days = daily.select(F.col("date_day").alias("date"), F.col("total_incidents").alias("incidents"))
    return days.filter(F.col("incidents") > cfg.outlier_day_threshold)


def exclude_days(frame: DataFrame, days: DataFrame, column: str) -> DataFrame:
    """Rows of the given days go, rows without a date stay.

    The days removed are the crowded ones, and shuffling the facts by day would
    gather just those. The set is broadcast instead: it holds distinct DATE
    values, of which the type has 3.65 million at four bytes each.
    """
    return frame.join(
        F.broadcast(days.select(F.col("date").alias(column))), column, "left_anti"
    )


def without_outliers(
    detail: DataFrame, spine: DataFrame, days: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """V3: both frames without the given outlier days."""
    return exclude_days(detail, days, "date"), exclude_days(spine, days, "date_day")


def search_match(query: str, column: str = "narrative", literal: bool = False) -> Column:
    """V5: case-insensitive; the query is a regular expression unless ``literal``."""
    text = F.col(column)
    hit = F.lower(text).contains(query.lower()) if literal else text.rlike("(?iU)" + query)
    return F.coalesce(hit, F.lit(False))


def filter_incidents(
    detail: DataFrame,
    start: date | None = None,
    end: date | None = None,
    semesters: Sequence[str] = (),
    zones: Sequence[str] = (),
    categories: Sequence[str] = (),
    search: str = "",
    literal: bool = False,
) -> DataFrame:
    """V4, V5: the user's filters; undated incidents pass the date range."""
    out = detail
    if start is not None and end is not None:
        out = out.filter(F.col("date").isNull() | F.col("date").between(F.lit(start), F.lit(end)))
    for column, chosen in (("semester", semesters), ("zone", zones), ("category", categories)):
        if chosen:
            out = out.filter(F.col(column).isin(*chosen))
    return out.filter(search_match(search, literal=literal)) if search else out


def filter_spine(
    spine: DataFrame,
    start: date | None = None,
    end: date | None = None,
    semesters: Sequence[str] = (),
) -> DataFrame:
    """V6: date range and semester only."""
    out = spine
    if start is not None and end is not None:
        out = out.filter(F.col("date_day").between(F.lit(start), F.lit(end)))
    return out.filter(F.col("semester").isin(*semesters)) if semesters else out


def headline(detail: DataFrame, spine: DataFrame) -> DataFrame:
    """V7, A5: one row of incidents, incidents per day and known zones.

    Each side is reduced to one row first; the two rows are stacked and summed.
    """
    counted = detail.agg(
        F.count(F.lit(1)).alias("incidents"),
        F.count_distinct(F.when(~F.col("zone_unknown"), F.col("zone"))).alias("zones"),
        F.lit(0).cast("bigint").alias("days"),
    )
    days = spine.agg(
        F.lit(0).cast("bigint").alias("incidents"),
        F.lit(0).cast("bigint").alias("zones"),
        F.count(F.lit(1)).alias("days"),
    )
    total = counted.unionByName(days).agg(
        *[F.sum(c).alias(c) for c in ("incidents", "zones", "days")]
    )
    return total.select(
        "incidents",
        (F.col("incidents") / F.greatest("days", F.lit(1))).alias("incidents_per_day"),
        "zones",
    )


def daily_counts(detail: DataFrame) -> DataFrame:
    """Dated incidents per day."""
    return (
        detail.filter(F.col("date").isNotNull())
        .groupBy(F.col("date").alias("date_day"))
        .agg(F.count(F.lit(1)).alias("incidents"))
    )


def daily_counts_on_spine(detail: DataFrame, spine: DataFrame) -> DataFrame:
    """Counts for every spine day, with its day type."""
    return spine.join(daily_counts(detail), "date_day", "left").select(
        "date_day",
        F.coalesce("incidents", F.lit(0)).alias("incidents"),
        day_type().alias("day_type"),
    )


def rolling_mean(daily: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Mean over the last rows of the filtered spine, two decimals half-even.

    The window has no partition key, so it runs in one task. Its input is one
    row per calendar day whatever the size of the facts.
    """
    last = Window.orderBy("date_day").rowsBetween(1 - cfg.rolling_days, Window.currentRow)
    return daily.withColumn("rolling", half_even(F.avg("incidents").over(last)))


def daily_trend(detail: DataFrame, spine: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """V8."""
    return rolling_mean(daily_counts_on_spine(detail, spine), cfg)


def calendar_effect(detail: DataFrame, spine: DataFrame) -> DataFrame:
    """Mean, days and total per day type, in fixed order."""
    order = F.array_position(F.array(*[F.lit(d) for d in DAY_TYPES]), F.col("day_type"))
    return (
        daily_counts_on_spine(detail, spine)
        .groupBy("day_type")
        .agg(
            half_even(F.avg("incidents")).alias("avg_per_day"),
            F.count(F.lit(1)).alias("days"),
            F.sum("incidents").alias("total"),
        )
        .orderBy(order)
    )


def _largest_first(detail: DataFrame, *by: str) -> DataFrame:
    counts = detail.groupBy(*by).agg(F.count(F.lit(1)).alias("incidents"))
    return counts.orderBy(F.desc("incidents"), *by)


def by_zone(detail: DataFrame) -> DataFrame:
    """Known zones."""
    return _largest_first(detail.filter(~F.col("zone_unknown")), "zone")


def by_category(detail: DataFrame) -> DataFrame:
    """A9."""
    return _largest_first(detail, "category")


def zone_category_grid(detail: DataFrame) -> DataFrame:
    """A10: observed cells of known zones."""
    return _largest_first(detail.filter(~F.col("zone_unknown")), "zone", "category")


def weekday_profile(detail: DataFrame) -> DataFrame:
    """Monday to Sunday, absent days 0; empty if nothing is dated.

    One aggregate row per weekday is folded into one map row, which is then
    unfolded over the fixed week; no rows means no map.
    """
    counts = (
        detail.filter(F.col("date").isNotNull())
        .groupBy(day_name(F.col("date")).alias("weekday"))
        .agg(F.count(F.lit(1)).alias("incidents"))
        .agg(F.map_from_entries(F.collect_list(F.struct("weekday", "incidents"))).alias("found"))
        .filter(F.size("found") > 0)
    )
    week = F.posexplode(F.array(*[F.lit(d) for d in WEEKDAYS])).alias("position", "weekday")
    return (
        counts.select("found", week)
        .select(
            "position",
            "weekday",
            F.coalesce(F.try_element_at("found", F.col("weekday")), F.lit(0)).alias("incidents"),
        )
        .orderBy("position")
        .drop("position")
    )


def filter_options(detail: DataFrame) -> DataFrame:
    """Distinct values to offer per filter, sorted.

    The facts are read once and reduced to the combinations that occur before
    these are unfolded to one row per filter and value.
    """
    columns = ("semester", "zone", "category")
    pairs = [F.struct(F.lit(c).alias("filter"), F.col(c).alias("value")) for c in columns]
    return (
        detail.select(*columns)
        .distinct()
        .select(F.explode(F.array(*pairs)).alias("option"))
        .select("option.filter", "option.value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("filter", "value")
    )


def spine_bounds(spine: DataFrame) -> DataFrame:
    """First and last day to offer."""
    return spine.agg(F.min("date_day").alias("first_day"), F.max("date_day").alias("last_day"))


def explorer(detail: DataFrame) -> DataFrame:
    """Five title-cased columns, newest first; a total order if ``detail`` has the row id."""
    row_id = [c for c in (ROW_ID,) if c in detail.columns]
    return newest_first(detail.select(*EXPLORER_COLUMNS, *row_id)).toDF(*[c.title() for c in EXPLORER_COLUMNS])


def match_counts(filtered: DataFrame, detail: DataFrame) -> DataFrame:
    """Matched of total, each side reduced to one row before they meet."""
    one = F.count(F.lit(1))
    zero = F.lit(0).cast("bigint")
    sides = filtered.agg(one.alias("matched"), zero.alias("total")).unionByName(
        detail.agg(zero.alias("matched"), one.alias("total"))
    )
    return sides.agg(F.sum("matched").alias("matched"), F.sum("total").alias("total"))
