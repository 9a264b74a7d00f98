"""A filter of bounded size for values of a column, joined before a shuffle.

Each value sets one bit of ``FILTER_BITS`` by its hash. Rows whose bit isn't set can't have a
marked value, so they need not move; others may, and an exact join follows. The filter's size
doesn't depend on the data: with very many values it lets more rows through, and costs no more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 64 in a row, so the filter has 524,288 rows at most.
FILTER_BITS = 1 << 25
AT, SLOT = "_llm_at", "_llm_slot"


def _place(value: Column) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(FILTER_BITS))


def marks(values: DataFrame, name: str) -> DataFrame:
    """A bit for each value of column ``name``."""
    at = values.select(_place(F.col(name)).alias(AT))
    bit = F.expr(f"shiftleft(1L, cast({AT} % 64 as int))")
    return at.groupBy(F.expr(f"{AT} div 64").alias(SLOT)).agg(F.bit_or(bit).alias("_llm_bits"))


def passing(df: DataFrame, name: str, marked: DataFrame) -> DataFrame:
    """Rows whose value may be among the marked ones."""
    given = df.columns
    at = df.withColumn(AT, _place(F.col(name))).withColumn(SLOT, F.expr(f"{AT} div 64"))
    both = at.join(F.broadcast(marked), SLOT)
    return both.where(f"(shiftright(_llm_bits, cast({AT} % 64 as int)) & 1L) = 1").select(given)
