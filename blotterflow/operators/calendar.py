"""Days and calendar periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def period_days(calendar: DataFrame) -> DataFrame:
    """Each day some period covers, with its label and flags.

    Periods are unfolded to days, so attaching them is an equi-join; a range
    condition would need a nested-loop or cross join. Where semesters overlap
    the one that starts first gives the label.
    """
    days = calendar.filter(F.col("start_date") <= F.col("end_date")).select(
        "period_type",
        "label",
        "start_date",
        F.explode(F.sequence("start_date", "end_date")).alias("date_day"),
    )

    def covered(period_type: str) -> Column:
        return F.bool_or(F.col("period_type") == period_type)

    semester = F.when(F.col("period_type") == "SEMESTER", F.struct("start_date", "label"))
    return days.groupBy("date_day").agg(
        F.min(semester).getField("label").alias("semester"),
        covered("FINALS").alias("is_finals"),
        covered("BREAK").alias("is_break"),
        covered("GAME_DAY").alias("is_game_day"),
    )


def with_periods(days: DataFrame, calendar: DataFrame) -> DataFrame:
    """Semester label and period flags for a frame of days."""
    joined = days.join(period_days(calendar), "date_day", "left")
    return joined.select(
        *days.columns,
        "semester",
        *[
            F.coalesce(flag, F.lit(False)).alias(flag)
            for flag in ("is_finals", "is_break", "is_game_day")
        ],
    )


def day_type() -> Column:
    """Finals before break before game day."""
    return (
        F.when(F.col("is_finals"), "Finals")
        .when(F.col("is_break"), "Break")
        .when(F.col("is_game_day"), "Game day")
        .otherwise("Regular")
    )
