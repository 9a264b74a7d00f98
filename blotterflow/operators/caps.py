"""Caps by key: the first n keys of a table.

No task ever holds or sorts the keys. They are counted by their leading characters, and
only the range that holds the n-th key is looked into further, by the next characters;
after a few rounds the key itself is known, and the cap is a plain filter on it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters by which a range is divided in one round. Hexadecimal keys make 256 ranges.
STEP = 2
#: A range with no more keys than this is read.
FEW = 1000


def nth_key(df: DataFrame, key: str, n: int) -> str | None:
    """The n-th distinct key of a string column, in order; None if there are fewer.

    NULL is no key. Order is that of Spark's strings: by code points.
    """
    keys = df.select(F.col(key).alias("key")).where("key IS NOT NULL")
    length = 0
    while True:
        length += STEP
        head = F.substring("key", 1, length)
        ranges = keys.groupBy(head.alias("head")).agg(F.count_distinct("key").alias("n"), F.max("key").alias("last"))
        found = None
        for r in sorted(ranges.collect(), key=lambda r: r.head):
            if n <= r.n:
                found = r
                break
            n -= r.n
        if found is None:
            return None
        if n == found.n:
            return found.last
        keys = keys.where(F.col("key").startswith(found.head) & (head == found.head))
        if found.n <= FEW:
            return sorted(r.key for r in keys.distinct().collect())[n - 1]


def among_first(df: DataFrame, key: str, n: int) -> Column:
    """Whether a row's key is one of the first ``n`` of ``df``; counted when this is called."""
    if n <= 0:
        return F.lit(False)
    last = nth_key(df, key, n)
    return F.col(key).isNotNull() if last is None else F.col(key) <= last
