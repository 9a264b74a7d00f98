"""Keyed operators: first seen, new rows, upserts.

All of them reduce rows per key with an aggregate, not a window: the map side
keeps one row per key and task, so a key that holds a third of all rows still
shuffles only one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: With no more recurring keys than this, their hashes are broadcast: eight bytes each.
FEW_RECURRING = 1 << 20


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], take) -> DataFrame:
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(take(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in df.columns])


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row per key; ``order`` must tell the rows of a key apart.

    Select the columns you need beforehand: the row travels as one struct, and
    Spark does not prune the fields of an aggregated struct.
    """
    return _pick(df, keys, order, F.min_by)


def last_seen(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The last row per key, otherwise as ``first_seen``."""
    return _pick(df, keys, order, F.max_by)


def last_seen_stored(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], path: str
) -> DataFrame:
    """``last_seen`` of a stored table in which most keys occur once.

    Hashes of the keys are counted first, eight bytes a row, and those met more than once
    are written to ``path``. Only rows with one of these are sorted and grouped by their keys; any
    other row is alone with its key and stays where it is. Where very many keys recur, all rows
    are grouped. ``df`` is read more than once, so it should be a table.
    """
    tag = F.xxhash64(*keys)
    counts = df.groupBy(tag.alias("_tag")).agg(F.count(F.lit(1)).alias("n"))
    counts.filter("n > 1").select("_tag").write.mode("overwrite").parquet(path)
    recurring = df.sparkSession.read.schema("_tag bigint").parquet(path)
    if recurring.count() > FEW_RECURRING:
        return last_seen(df, keys, order)
    tagged, met = df.withColumn("_tag", tag), F.broadcast(recurring)
    alone = tagged.join(met, "_tag", "left_anti").select(*df.columns)
    return alone.unionByName(last_seen(tagged.join(met, "_tag", "left_semi").select(*df.columns), keys, order))


def known_keys(landed: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Incoming keys that have landed before.

    The semi-join keeps the batch on the side Spark can broadcast: a small batch
    then costs a scan of the landed key column and no shuffle of it.
    """
    return landed.select(key).join(incoming.select(key), key, "left_semi")


def new_rows(
    landed: DataFrame, incoming: DataFrame, key: str, order: Sequence[Column | str]
) -> DataFrame:
    """First copy of each incoming key that has not landed yet.

    Rows without a key are rejected: they cannot be told apart. ``insert_counts``
    counts them.
    """
    incoming = incoming.filter(F.col(key).isNotNull())
    known = known_keys(landed, incoming, key)
    return first_seen(incoming, [key], order).join(known, key, "left_anti")


def insert_counts(landed: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """One row of (inserted, skipped, rejected); in-batch copies count as skipped.

    Rows without a key are rejected. Copies are counted per key first, so the join
    moves distinct keys only.
    """
    copies = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
    known = known_keys(landed, incoming, key).distinct().withColumn("known", F.lit(True))
    keyed = F.col(key).isNotNull()
    inserted = F.count(F.when(F.col("known").isNull() & keyed, 1))
    zero = F.lit(0).cast("bigint")
    return copies.join(known, key, "left").agg(
        inserted.alias("inserted"),
        (F.coalesce(F.sum(F.when(keyed, F.col("copies"))), zero) - inserted).alias("skipped"),
        F.coalesce(F.sum(F.when(~keyed, F.col("copies"))), zero).alias("rejected"),
    )


def upsert(
    existing: DataFrame, incoming: DataFrame, key: str, order: Sequence[Column | str]
) -> DataFrame:
    """Incoming rows win; among equal incoming keys the last one wins.

    ``existing`` has one row per key, so only the batch is reduced; stored rows
    pass through an anti-join on the batch's keys and are not sorted or grouped.
    """
    latest = last_seen(incoming, [key], order).select(*existing.columns)
    return existing.join(latest.select(key), key, "left_anti").unionByName(latest)


def replace_children(
    existing: DataFrame, incoming: DataFrame, touched: DataFrame, key: str
) -> DataFrame:
    """Children of touched parents are replaced as a whole.

    A touched parent without incoming children loses its old ones.
    """
    return existing.join(touched.select(key).distinct(), key, "left_anti").unionByName(
        incoming.select(*existing.columns)
    )
