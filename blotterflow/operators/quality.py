"""Data-quality checks (Q1-Q5); each gives a count of failures."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, column: str) -> DataFrame:
    """Q1: non-null keys that occur more than once."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1")
    )


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Q2: rows without a value."""
    return df.filter(F.col(column).isNull())


def unaccepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Q3: values outside the list, with their row counts; NULL passes."""
    return (
        df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*values))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Q4: foreign keys without a parent, with their row counts; NULL passes.

    Children are counted per key before the join, so a key that holds much of
    the table moves as one row per task.
    """
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("key"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return used.join(parent.select(F.col(parent_column).alias("key")), "key", "left_anti")


@dataclass(frozen=True, eq=False)
class Check:
    """A declared check of one column; a link also names its parent's key."""

    kind: str
    table: str
    column: str
    frame: DataFrame
    values: tuple[str, ...] = ()
    parent: DataFrame | None = None
    parent_column: str = ""


def unique(df: DataFrame, table: str, column: str) -> Check:
    return Check("unique", table, column, df)


def not_null(df: DataFrame, table: str, column: str) -> Check:
    return Check("not_null", table, column, df)


def accepted_values(df: DataFrame, table: str, column: str, values: Sequence[str]) -> Check:
    return Check("accepted_values", table, column, df, values=tuple(values))


def relationship(
    child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str
) -> Check:
    return Check("relationships", table, column, child, parent=parent, parent_column=parent_column)


def _findings(frame: DataFrame, checks: Sequence[tuple[int, Check]], parents: Sequence[tuple[int, str]]) -> DataFrame:
    """What one table has to say about the checks it takes part in: (check_no, key, rows, is_parent).

    Its rows are grouped once, by each column that a check compares, in the column's own
    type; columns that are only looked through for NULL ride along as counts. A row of the result is a
    number of failures, or one value that a link has on either side.
    """
    plain = [(i, c) for i, c in checks if c.kind == "not_null"]
    keyed = [(i, c) for i, c in checks if c.kind != "not_null"]
    columns = list(dict.fromkeys([c.column for _, c in keyed] + [column for _, column in parents]))
    counts = [F.count(F.lit(1)).alias("n")]
    counts += [F.count(F.when(F.col(f"looked{i}").isNull(), 1)).alias(f"nulls{i}") for i, _ in plain]
    typed = frame.select(
        *[F.col(c).alias(f"k{j}") for j, c in enumerate(columns)], *[F.col(c.column).alias(f"looked{i}") for i, c in plain]
    )
    if columns:
        sets = [[F.col(f"k{j}")] for j in range(len(columns))]
        seen = typed.groupingSets(sets, *[s[0] for s in sets]).agg(*counts, F.grouping_id().alias("set"))
    else:
        seen = typed.agg(*counts, F.lit(0).cast("bigint").alias("set"))
    full = (1 << len(columns)) - 1

    def group(j: int) -> Column:
        return F.col("set") == full - (1 << (len(columns) - 1 - j))

    def row(i: int, when: Column, rows: Column, key: Column = F.lit(None).cast("string"), is_parent: bool = False) -> Column:
        cells = F.struct(F.lit(i).alias("check_no"), key.alias("key"), rows.cast("bigint").alias("rows"), F.lit(is_parent).alias("is_parent"))
        return F.when(when, cells)

    zero, one, n, out = F.lit(0), F.lit(1), F.col("n"), []
    for i, _ in plain:
        out.append(row(i, (group(0) if columns else F.lit(True)) & (F.col(f"nulls{i}") > 0), F.col(f"nulls{i}")))
    for i, c in keyed:
        j = columns.index(c.column)
        value, here = F.col(f"k{j}"), group(columns.index(c.column))
        if c.kind == "unique":
            out.append(row(i, here & value.isNotNull() & (n > 1), one))
        elif c.kind == "accepted_values":
            out.append(row(i, here & value.isNotNull() & ~value.isin(*c.values), one))
        else:
            out.append(row(i, here & value.isNotNull(), n, value.cast("string")))
    for i, column in parents:
        j = columns.index(column)
        out.append(row(i, group(j) & F.col(f"k{j}").isNotNull(), zero, F.col(f"k{j}").cast("string"), True))
    return seen.select(F.inline(F.filter(F.array(*out), lambda x: x.isNotNull())))


def run_suite(checks: Sequence[Check]) -> DataFrame:
    """Q5: one row per check.

    Every table is scanned once and its rows are grouped before they move, so a key that
    holds much of a table is one row per task. What the tables find is put together in one
    pass: failures are summed, and a link's child values that no parent has are counted.
    """
    if not checks:
        raise ValueError("a suite needs a check")
    frames: dict[int, tuple[DataFrame, list, list]] = {}
    for i, c in enumerate(checks):
        frames.setdefault(id(c.frame), (c.frame, [], []))[1].append((i, c))
        if c.parent is not None:
            frames.setdefault(id(c.parent), (c.parent, [], []))[2].append((i, c.parent_column))
    found = reduce(DataFrame.unionByName, [_findings(*f) for f in frames.values()])
    met = found.groupBy("check_no", "key").agg(F.sum("rows").alias("rows"), F.bool_or("is_parent").alias("found"))
    failed = F.when(~F.col("found"), F.col("rows"))
    sums = met.agg(*[F.sum(F.when(F.col("check_no") == i, failed)).alias(f"c{i}") for i in range(len(checks))])
    cells = [
        F.struct(
            F.lit(c.kind).alias("check_kind"),
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return sums.select(F.inline(F.array(*cells)))
