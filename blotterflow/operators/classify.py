"""Incident text to zone."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterflow.config import DEFAULT, UNKNOWN, PipelineConfig
from blotterflow.functions import rules as R
from blotterflow.functions.text import fold_text
from blotterflow.operators.caps import among_first

Model = Callable[[pd.Series], pd.Series]
#: Distinct texts to their answers: ``text`` to ``text, proposed``.
Answers = Callable[[DataFrame], DataFrame]

LOOKUP_TYPE = "struct<zone:string,source:string,reasoning:string>"
# fixed values: the four reasons
NO_MODEL_REASON = "no explicit location in text"
NO_PLACE_REASON = "model found no explicit location"
KEPT_REASON = "model matched an explicit place"


def with_lookup(
    df: DataFrame, text: Column, out: str = "hit", cfg: PipelineConfig = DEFAULT
) -> DataFrame:
    """Adds ``_text`` (T2) and ``out``, a struct or NULL on a miss."""
    placed = F.struct(
        R.rule_value(cfg.place_rules, F.col("_rule")).alias("zone"),
        F.lit("landmark").alias("source"),
        F.concat(
            F.lit("matched '"),
            R.rule_matched_text(cfg.place_rules, F.col("_rule"), F.col("_text")),
            F.lit("'"),
        ).alias("reasoning"),
    )
    parked = F.struct(
        R.lot_zone(F.col("_lot"), cfg).alias("zone"),
        F.lit("lot").alias("source"),
        F.concat(F.lit("parking Lot "), F.col("_lot").cast("string")).alias("reasoning"),
    )
    return (
        df.withColumn("_text", fold_text(text))
        .withColumn("_rule", R.first_rule(cfg.place_rules, F.col("_text")))
        .withColumn("_lot", F.when(F.col("_rule").isNull(), R.lot_number(F.col("_text"))))
        .withColumn(
            out,
            F.when(F.col("_rule").isNotNull(), placed).when(
                R.lot_zone(F.col("_lot"), cfg).isNotNull(), parked
            ),
        )
        .drop("_rule", "_lot")
    )


def model_fallback(model: Model) -> Callable[[Column], Column]:
    """A batch model as a column function.

    NULL inputs are rows the model must not see; they are taken out before the
    call. A batch that fails is retried row by row, and a row that fails gives
    UNKNOWN.
    """

    def tidy(answer) -> str:
        return str(answer).strip().upper()

    def one(text: str) -> str:
        try:
            return tidy(model(pd.Series([text])).iloc[0])
        except Exception:
            return UNKNOWN

    def propose(texts: pd.Series) -> pd.Series:
        asked = texts.dropna()
        if asked.empty:
            return pd.Series([None] * len(texts), dtype=object)
        try:
            answers = [tidy(a) for a in model(asked.reset_index(drop=True))]
            if len(answers) != len(asked):
                raise ValueError("one answer per text is needed")
        except Exception:
            answers = [one(t) for t in asked]
        return pd.Series(answers, index=asked.index, dtype=object).reindex(texts.index)

    return F.pandas_udf(propose, "string").asNondeterministic()


def ask(texts: DataFrame, model: Model) -> DataFrame:
    """The model's answer to each row of ``texts(text)``."""
    return texts.select("text", model_fallback(model)(F.col("text")).alias("proposed"))


def guarded(hit: Column, proposed: Column, names_place: Column, cfg: PipelineConfig) -> Column:
    """C6 with a model: a zone stands only if the text names a place."""
    known = F.when(proposed.isin(*cfg.zones), proposed).otherwise(UNKNOWN)

    def result(zone: Column | str, source: str, reasoning: Column | str) -> Column:
        as_col = [x if isinstance(x, Column) else F.lit(x) for x in (zone, source, reasoning)]
        return F.struct(
            as_col[0].alias("zone"), as_col[1].alias("source"), as_col[2].alias("reasoning")
        )

    fabricated = F.concat(
        F.lit("model proposed "), known, F.lit(" but text names no explicit place")
    )
    return (
        F.when(hit.isNotNull(), hit)
        .when(known == UNKNOWN, result(UNKNOWN, "llm", NO_PLACE_REASON))
        .when(~names_place, result(UNKNOWN, "guardrail", fabricated))
        .otherwise(result(known, "llm", KEPT_REASON))
    )


def classify(
    df: DataFrame,
    text_col: str = "incident_text",
    cfg: PipelineConfig = DEFAULT,
    model: Model | None = None,
    only: Column | None = None,
    out: str = "location",
    answers: Answers | None = None,
) -> DataFrame:
    """Adds a struct of zone, source and reasoning.

    One pass over the input: rules run in the JVM, and the model column gets
    the text of misses and NULL for every other row. Rows outside ``only`` get
    NULL and cost no rule.

    With ``answers`` in place of ``model``, each distinct text that the rules miss is looked up there
    once, and the answer is joined to its rows: rules run twice, and the model as seldom as can be.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    wanted = F.lit(True) if only is None else F.coalesce(only, F.lit(False))
    looked = with_lookup(
        df.withColumn("_wanted", wanted), F.when(F.col("_wanted"), text), "_hit", cfg
    )
    missing = F.col("_hit").isNull() & F.col("_wanted")
    if answers is not None:
        given = answers(looked.filter(missing).select(F.col("_text").alias("text")).distinct())
        # rows that ask nothing are spread by their own text, and find no answer that is used
        key = F.coalesce("_text", text)
        named = given.select(F.col("text").alias("_asked"), F.col("proposed").alias("_proposed"))
        looked = looked.withColumn("_key", key).join(named, F.col("_key") == F.col("_asked"), "left")
        result = guarded(F.col("_hit"), F.col("_proposed"), R.names_place(F.col("_text"), cfg), cfg)
    elif model is None:
        missed = F.struct(
            F.lit(UNKNOWN).alias("zone"),
            F.lit("none").alias("source"),
            F.lit(NO_MODEL_REASON).alias("reasoning"),
        )
        result = F.coalesce("_hit", missed)
    else:
        asked = F.when(missing, F.col("_text"))
        looked = looked.withColumn("_proposed", model_fallback(model)(asked))
        result = guarded(
            F.col("_hit"), F.col("_proposed"), R.names_place(F.col("_text"), cfg), cfg
        )
    return looked.withColumn(out, F.when(F.col("_wanted"), result)).select(*df.columns, out)


def classify_pending(
    raw: DataFrame,
    cfg: PipelineConfig = DEFAULT,
    model: Model | None = None,
    limit: int | None = None,
    key: str = "raw_text_hash",
    answers: Answers | None = None,
) -> DataFrame:
    """Rows without a zone get one; the others stay as they are.

    With ``limit`` only the rows of the first pending keys are taken, in key order so that
    runs repeat.
    """
    pending = F.col("location_zone").isNull()
    if limit is not None:
        pending = pending & among_first(raw.filter(pending), key, limit)
    done = classify(raw.withColumn("_pending", pending), cfg=cfg, model=model, only=F.col("_pending"), answers=answers)
    fields = {
        "location_zone": F.col("location.zone"),
        "location_confidence": R.confidence(F.col("location.source"), cfg),
        "location_source": F.col("location.source"),
        "location_reasoning": F.col("location.reasoning"),
    }
    found = F.col("location").isNotNull()
    filled = {
        name: F.when(found, value).otherwise(F.col(name))
        for name, value in fields.items()
        if name in raw.columns
    }
    return done.withColumns(filled).select(*raw.columns)


def source_counts(classified: DataFrame, source_col: str = "location_source") -> DataFrame:
    """Rows per deciding layer."""
    return classified.groupBy(F.col(source_col).alias("location_source")).agg(
        F.count(F.lit(1)).alias("incidents")
    )
