"""The registered queries of this subpackage, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterflow.llm import (
    chat_format,
    decontaminate,
    hard_negatives,
    jaccard_join,
    language_id,
    quality_rules,
    ranked_search,
    sentencepiece_codec,
    simhash_dedup,
    substring_dedup,
    toxicity,
    url_filter,
    warc,
)
from blotterflow.llm.batches import without

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_substring_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = substring_dedup.substring_dedup(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op5_simhash_dedup(spark, sf):
    return simhash_dedup.near_duplicates(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op3_decontaminate(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = decontaminate.contamination(docs, table(spark, sf, "benchmark"))
    return out.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@query
def op10_sentencepiece(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = sentencepiece_codec.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_language_id(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    out = language_id.identify(docs)
    return out.select("doc_id", language_id.held_out("doc_id").alias("held_out"), "lang_pred", "score", "similarity", "rejected")


@query
def op4_quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    trusted = table(spark, sf, "labels").where("quality = 1").select("doc_id")
    return without(quality_rules.quality(docs, trusted), "text")


@query
def op9_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    out = toxicity.score(docs, model)
    return out.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


@query
def op6_url_filter(spark, sf):
    return url_filter.judge_urls(table(spark, sf, "pages").select("page_id", "url")).drop("url")


@query
def op7_chat_format(spark, sf):
    return chat_format.rotate_perspectives(table(spark, sf, "conversations"))


@query
def op8_warc(spark, sf):
    records = warc.round_trip(table(spark, sf, "pages").select("page_id", "url", "html"))
    page = F.regexp_extract("record_id", f"^{warc.PREFIX}(-?[0-9]+)$", 1).cast("long")
    return records.select(
        page.alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.regexp_extract("refers_to", f"^{warc.PREFIX}(-?[0-9]+)$", 1).cast("long").alias("refers_to"),
    )


@query
def op11_jaccard_join(spark, sf):
    return jaccard_join.jaccard_classes(table(spark, sf, "documents").select("doc_id", "text"))


@query
def op12_ranked_search(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ranked_search.search(docs, table(spark, sf, "benchmark"))


@query
def op13_hard_negatives(spark, sf):
    vectors = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 50 == 0)
