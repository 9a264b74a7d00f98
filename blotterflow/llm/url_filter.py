"""URL filters: rules first, gradient-boosted trees for the rest.

A rule ``host/path`` fits URLs of its host and of all hosts under it whose path starts
with ``/path``; of several that fit, the longest decides. URLs that rules decide are the
labelled ones. Trees learn from lexical features: lengths, depth, digit ratio, entropy
of the characters, numbers of parameters, and statistics of the host's suffix (its last
label): how many URLs have it, and how many of the labelled ones are blocked, drawn
towards one half where there are few. Every URL no rule fits gets the trees' verdict.

Everything is DataFrame operations and MLlib. Suffixes are counted before the shuffle;
the counts join by suffix as Spark sees fit. The trees learn from at most ``SAMPLE``
labelled URLs of each label, those with the smallest hashes, in a fixed order.

Cases: a URL that is null or has no ``://`` has an empty host and path, and gets the
trees' verdict. Repeated rows get equal results and count as often as they stand. With
URLs of one label only, or none, all others are allowed. An empty table gives no rows.
Columns of the input with the names of the output are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterflow.llm.batches import without
from blotterflow.llm.tables import stored

#: (verdict, host and start of the path)
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: At most so many labelled URLs of each verdict are learned from.
SAMPLE = 5_000
TREES, DEPTH = 10, 4
NUMBERS = (
    "url_length",
    "host_length",
    "path_length",
    "host_labels",
    "depth",
    "digit_ratio",
    "entropy",
    "parameters",
    "parameter_length",
    "suffix_count",
    "suffix_blocked",
)
OUT = ("host", "path", "rule", "score", "verdict")
URL = "_llm_url"


def _fold(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path."""
    parts = F.coalesce(url, F.lit(""))
    host = _fold(F.regexp_extract(parts, r"^(?s:.*?)://([^/?#]*)", 1))
    path = F.regexp_extract(parts, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)
    return host, path


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, _, start = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Shannon entropy, in bits, of a text's characters: runs of the sorted characters are summed."""
    characters = F.array_sort(F.filter(F.split(text, ""), lambda c: c != ""))
    n = F.size(characters).cast("double")
    start = F.struct(F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("total"))

    def weight(run):
        return F.when(run > 0, run * F.log2(run)).otherwise(0.0)

    def step(s, c):
        same = s["last"] == c
        return F.struct(
            c.alias("last"),
            F.when(same, s["run"] + 1).otherwise(1.0).alias("run"),
            F.when(same, s["total"]).otherwise(s["total"] + weight(s["run"])).alias("total"),
        )

    total = F.aggregate(characters, start, step, lambda s: s["total"] + weight(s["run"]))
    return F.when(n > 0, F.log2(n) - total / n).otherwise(0.0)


def with_features(urls: DataFrame, url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``urls`` with host, path, rule, its verdict as ``_llm_verdict``, and the features in ``_llm_numbers``."""
    df = without(urls.withColumn(URL, F.coalesce(F.col(url_col), F.lit(""))), *[n for n in OUT if n != url_col])
    host, path = split_url(F.col(URL))
    df = df.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    url, query = F.col(URL), F.regexp_extract(F.col(URL), r"\?([^#]*)", 1)
    digits = F.length(F.regexp_replace(url, "[^0-9]", ""))
    numbers = {
        "url_length": F.length(url),
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "host_labels": F.size(F.split("host", r"\.")),
        "depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")),
        "digit_ratio": digits / F.greatest(F.length(url), F.lit(1)),
        "entropy": _entropy(url),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda x: x != "")),
        "parameter_length": F.length(query),
    }
    return df.withColumns(
        {
            "rule": rule,
            "_llm_verdict": verdict,
            "_llm_suffix": F.regexp_extract("host", r"([^.]*)$", 1),
            "_llm_numbers": F.struct(*[c.cast("double").alias(n) for n, c in numbers.items()]),
        }
    )


def suffix_statistics(given: DataFrame) -> DataFrame:
    blocked, labelled = F.col("_llm_verdict") == "block", F.col("_llm_verdict").isNotNull()
    return given.groupBy("_llm_suffix").agg(
        F.log1p(F.count("*")).alias("_llm_suffix_count"),
        ((F.count_if(blocked) + 1) / (F.count_if(labelled) + 2)).alias("_llm_suffix_blocked"),
    )


def _assembled(df: DataFrame) -> DataFrame:
    names = [f"_llm_{n}" for n in NUMBERS]
    flat = df.withColumns({f"_llm_{n}": F.col(f"_llm_numbers.{n}") for n in NUMBERS[:-2]})
    return VectorAssembler(inputCols=names, outputCol="_llm_features").transform(flat)


def fit(given: DataFrame, statistics: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> GBTClassificationModel | None:
    """Trees from the distinct labelled URLs of ``given``."""
    labelled = given.where("_llm_verdict is not null").select("_llm_verdict", URL).distinct()
    sample = None
    for verdict in ("allow", "block"):
        part = labelled.where(F.col("_llm_verdict") == verdict).orderBy(F.xxhash64(URL), URL).limit(SAMPLE)
        sample = part if sample is None else sample.unionByName(part)
    featured = with_features(sample.select(F.col(URL).alias("url")), "url", rules).join(statistics, "_llm_suffix")
    # bounded: the same rows in the same order give the same trees
    rows = _assembled(featured.coalesce(1).sortWithinPartitions("_llm_verdict", URL)).select(
        "_llm_features", (F.col("_llm_verdict") == "block").cast("double").alias("_llm_label")
    )
    rows = rows.persist()
    try:
        if rows.agg(F.count_distinct("_llm_label")).first()[0] < 2:
            return None
        trees = GBTClassifier(
            featuresCol="_llm_features", labelCol="_llm_label", maxIter=TREES, maxDepth=DEPTH, seed=7, cacheNodeIds=False
        )
        return trees.fit(rows)
    finally:
        rows.unpersist()


def judge_urls(urls: DataFrame, url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``urls`` with host, path, rule, score (the trees' probability of block) and verdict."""
    given = with_features(urls, url_col, rules)
    statistics = stored(suffix_statistics(given), "suffixes")
    model = fit(given, statistics, rules)
    given = given.join(statistics, "_llm_suffix")
    if model is None:
        scored = given.withColumn("score", F.lit(0.0))
    else:
        model.setProbabilityCol("_llm_probability").setPredictionCol("_llm_prediction").setRawPredictionCol("_llm_raw")
        scored = model.transform(_assembled(given)).withColumn("score", vector_to_array("_llm_probability")[1])
    verdict = F.coalesce("_llm_verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    kept = [c for c in scored.columns if not c.startswith("_llm_")]
    return scored.withColumn("verdict", verdict).select(*kept, "verdict")
