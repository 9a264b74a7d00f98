"""Catch-up run over new landing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterflow.config import DEFAULT, PipelineConfig
from blotterflow.operators.classify import Model, classify_pending
from blotterflow.operators.dedup import new_rows
from blotterflow.operators.normalize import DOCUMENT_ORDER
from blotterflow.schemas import RAW_INCIDENTS
from blotterflow.sources.landed_keys import prefix
from blotterflow.sources.store import KEY, IncidentStore


def land_batch(
    store: IncidentStore,
    batch: DataFrame,
    cfg: PipelineConfig = DEFAULT,
    model: Model | None = None,
    limit: int | None = None,
) -> int:
    """I2, C7, N5-N8 for one batch; the number of documents classified.

    Repeating a batch is harmless: what it committed before has landed, so
    nothing of it is new. Documents without a hash are rejected; the commit counts them,
    and the incidents per deciding layer (C8). Of the landed keys only those with a prefix
    that the batch has are read. The model is asked for each distinct text once, over all batches. With a ``limit``, what is over waits in the store and comes first in the
    next batch, whether that is capped or not.
    """
    keyed = F.when(F.col(KEY).isNotNull(), prefix(KEY))
    seen = batch.agg(F.count(F.lit(1)).alias("rows"), F.count(KEY).alias("keyed"), F.collect_set(keyed).alias("prefixes")).first()
    fresh = new_rows(store.landed_keys(seen.prefixes), batch, KEY, DOCUMENT_ORDER)
    taken, progress = store.take(fresh, limit)
    answers = None if model is None else lambda texts: store.ask(texts, model)
    classified = classify_pending(taken, cfg, answers=answers)
    # new rows hold each key once, and what waits had not landed before either
    store.write_batch(classified, received=seen.rows, rejected=seen.rows - seen.keyed, progress=progress, one_a_key=True)
    return sum(store.last_commit().sources.values())


def run_available(
    spark: SparkSession,
    landing: str,
    store: IncidentStore,
    checkpoint: str,
    cfg: PipelineConfig = DEFAULT,
    model: Model | None = None,
    files_per_batch: int = 1000,
    limit: int | None = None,
) -> None:
    """Process every landing file not seen before, then stop.

    The stream's checkpoint remembers the files, and the store's keys remember
    the incidents. Keys never expire, so they are looked up in the table rather
    than kept as stream state. Call it from any scheduler. A run classifies ``limit``
    documents at most, over all its batches; it takes up what earlier ones have left even if no file is new.
    """
    room = limit

    def land(batch: DataFrame, number: int) -> None:
        nonlocal room
        done = land_batch(store, batch, cfg, model, room)
        room = None if room is None else room - done

    (
        spark.readStream.schema(RAW_INCIDENTS)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    last = store.last_commit()
    if last is not None and last.waiting and room != 0:
        land(spark.createDataFrame([], RAW_INCIDENTS), -1)
