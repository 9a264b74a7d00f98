"""The corpus pipeline: five operators in a row over the table of documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterflow.llm import decontaminate, language_id, sentencepiece_codec, simhash_dedup, substring_dedup
from blotterflow.llm.batches import hidden
from blotterflow.llm.tables import new_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages."""
    return language_id.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash_dedup.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words that repeat earlier passages; one of which nothing is left goes.

    A document that loses no word keeps its text as it is.
    """
    given = hidden(docs)  # a column of docs may have the name of one that the operator adds
    own = dict(zip(docs.columns, given.columns, strict=True))
    cut = substring_dedup.substring_dedup(given, own["doc_id"], own["text"]).where("n_removed = 0 or n_removed < n_words")
    removed = F.col("n_removed") > 0
    left = cut.withColumn(own["text"], F.when(removed, F.col("kept_text")).otherwise(F.col(own["text"])))
    counted = F.length(own["text"]).cast(docs.schema["n_chars"].dataType)
    left = left.withColumn(own["n_chars"], F.when(removed, counted).otherwise(F.col(own["n_chars"])))
    return left.select(given.columns).toDF(*docs.columns)


def contamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids, and whether these decode to the text."""
    coded = sentencepiece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "lang", "source", "text", "ids", F.size("ids").cast("long").alias("n_tokens"), same.alias("same"))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("contamination", contamination),
    ("tokens", tokens),
]

#: Language ID and SimHash can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
