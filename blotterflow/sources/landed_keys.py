"""Landed keys laid out by a prefix of their hash.

A batch touches as many prefixes as it has keys at most, and a look-up reads the folders of
these only: the prefixes are literals, so Spark prunes the others before the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the prefix. More prune better, and cost a folder each in every batch with as many keys.
PREFIX_BITS = 6


def prefix(key: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - PREFIX_BITS).cast("int")


def write_keys(df: DataFrame, key: str, path: str) -> None:
    """The keys of ``df``, one folder for each prefix and one file in it."""
    keys = df.select(key, prefix(key).alias("prefix"))
    keys.repartition("prefix").sortWithinPartitions("prefix", key).write.mode("overwrite").partitionBy("prefix").parquet(path)


def with_prefixes(keys: DataFrame, prefixes: Sequence[int]) -> DataFrame:
    """The landed keys that have one of the prefixes."""
    if len(prefixes) == 1 << PREFIX_BITS:
        return keys
    return keys.where(F.col("prefix").isin(*sorted(prefixes)) if prefixes else F.lit(False))
