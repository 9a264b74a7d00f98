"""Written intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from blotterflow.session import shared_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def new_path(spark: SparkSession, name: str) -> str:
    """A folder nobody else uses, in ``spark.checkpoint.dir``."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written and read back: later steps neither repeat its work nor lose it.

    Spark's Parquet commit makes it safe against lost executors and repeated tasks.
    The shuffle files of the write go when it is done.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``stored`` that no later step reads."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
