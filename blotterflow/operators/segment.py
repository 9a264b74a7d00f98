"""Lines to incidents.

A page's lines stay together in one array column: segmenting is row-local, so
no line is ever shuffled. Only the choice between the containers of a page
groups rows, and by then each row has been reduced to its incidents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotterflow.config import DEFAULT, PipelineConfig
from blotterflow.functions.text import (
    clean_type,
    collapse_ws,
    has_marker,
    is_noise_line,
    is_plausible_incident_type,
    is_strict_heading_candidate,
    is_title_or_date_line,
    split_lines,
)

INCIDENTS_TYPE = "array<struct<incident_type:string,incident_text:string>>"
# A heading, one further line whatever it is, then lines that are no headings.
# Each line carries its tag (H or T) in front. The last group is possessive:
# Java runs it as a loop, so a long incident cannot exhaust the stack.
FLAT_INCIDENT = r"(?md)^H[^\n]*\n[HT][^\n]*\n(?:T[^\n]*\n)*+"


def with_clean_lines(
    df: DataFrame, text_col: str, out: str = "lines", cfg: PipelineConfig = DEFAULT
) -> DataFrame:
    """Raw text to clean lines: T1 per line, T13, T8, T12.

    T13 keeps the lines before the first marker line, T12 drops blank lines at
    the ends. Steps that are used twice are columns of their own, so that they
    run once per row.
    """
    marked = F.array_position(F.transform("_all", lambda x: has_marker(x, cfg)), True)
    before = F.when(F.col("_mark") == 0, F.col("_all")).otherwise(
        F.slice("_all", 1, (F.col("_mark") - 1).cast("int"))
    )
    kept = F.array_join(F.filter(before, lambda x: ~is_noise_line(x, cfg)), "\n")
    return (
        df.withColumn("_all", F.transform(split_lines(F.col(text_col)), collapse_ws))
        .withColumn("_mark", marked)
        .withColumn("_kept", F.btrim(kept, F.lit("\n")))
        .withColumn(
            out,
            F.when(F.col("_kept") == "", F.array().cast("array<string>")).otherwise(
                F.split("_kept", "\n")
            ),
        )
        .drop("_all", "_mark", "_kept")
    )


def nonempty_blocks(lines: Column) -> Column:
    """G1: runs of non-blank lines, each an array of lines."""
    text = F.btrim(F.array_join(lines, "\n"), F.lit("\n"))
    blocks = F.filter(F.split(text, r"\n\n+"), lambda b: b != "")
    return F.transform(blocks, lambda b: F.split(b, "\n"))


def with_block_incidents(
    df: DataFrame, lines: str = "lines", out: str = "block", cfg: PipelineConfig = DEFAULT
) -> DataFrame:
    """First line of a block is the type, the rest the text."""
    body = F.transform(
        nonempty_blocks(F.col(lines)),
        lambda b: F.filter(b, lambda x: ~is_title_or_date_line(x, cfg)),
    )
    found = F.transform(
        F.filter("_bodies", lambda b: F.size(b) >= 2),
        lambda b: F.struct(
            clean_type(F.get(b, 0)).alias("incident_type"),
            collapse_ws(F.array_join(F.slice(b, 2, F.size(b)), " ")).alias("incident_text"),
        ),
    )
    return (
        df.withColumn("_bodies", body)
        .withColumn("_found", found)
        .withColumn(
            out,
            F.filter(
                "_found",
                lambda i: is_plausible_incident_type(i.incident_type, cfg)
                & (i.incident_text != ""),
            ),
        )
        .drop("_bodies", "_found")
    )


def with_flat_incidents(
    df: DataFrame, lines: str = "lines", out: str = "flat", cfg: PipelineConfig = DEFAULT
) -> DataFrame:
    """Headings open incidents across blank lines.

    A heading directly after a heading is the latter's text, lines before the
    first heading are dropped, and so is a last heading without text. That is a
    left-to-right match of ``FLAT_INCIDENT`` over the tagged lines.
    """
    tagged = F.transform(
        F.filter(lines, lambda x: (x != "") & ~is_title_or_date_line(x, cfg)),
        lambda x: F.concat(
            F.when(is_strict_heading_candidate(x, cfg), "H").otherwise("T"), x, F.lit("\n")
        ),
    )
    chunks = F.regexp_extract_all(F.array_join("_tagged", ""), F.lit(FLAT_INCIDENT), F.lit(0))

    def to_incident(chunk: Column) -> Column:
        # newlines left between the text lines are whitespace to T1
        heading = F.substring(F.substring_index(chunk, "\n", 1), 2, 1 << 30)
        text = F.regexp_replace(chunk, r"\A[^\n]*\n|(?md)^[HT]", "")
        return F.struct(
            clean_type(heading).alias("incident_type"), collapse_ws(text).alias("incident_text")
        )

    return (
        df.withColumn("_tagged", tagged)
        .withColumn("_chunks", chunks)
        .withColumn(out, F.transform("_chunks", to_incident))
        .drop("_tagged", "_chunks")
    )


def pick_form(block: Column, flat: Column) -> Column:
    """The flat form only where it finds strictly more incidents."""
    return F.when(F.size(flat) > F.size(block), flat).otherwise(block)


def paragraph_incidents(
    flat_text: Column, spans: Column, cfg: PipelineConfig = DEFAULT
) -> Column:
    """Each paragraph is an incident of blank type."""
    texts = F.transform(
        spans, lambda s: collapse_ws(F.substring(flat_text, s.start + 1, s.length))
    )
    kept = F.filter(
        texts,
        lambda t: (t != "")
        & ~has_marker(t, cfg)
        & ~is_title_or_date_line(t, cfg)
        & ~is_noise_line(t, cfg),
    )
    return F.transform(
        kept, lambda t: F.struct(F.lit("").alias("incident_type"), t.alias("incident_text"))
    )


def segment_lines(df: DataFrame, lines: str = "lines", cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """G2-G4 on an array column of clean lines; adds ``incidents``."""
    both = with_flat_incidents(with_block_incidents(df, lines, cfg=cfg), lines, cfg=cfg)
    return both.withColumn("incidents", pick_form(F.col("block"), F.col("flat"))).drop("block", "flat")


def container_incidents(containers: DataFrame, cfg: PipelineConfig = DEFAULT) -> DataFrame:
    """Incidents of each container: G4, or G5 where that finds none."""
    fallback = paragraph_incidents(F.col("flat_text"), F.col("paragraph_spans"), cfg)
    return (
        segment_lines(with_clean_lines(containers, "raw_text", cfg=cfg), cfg=cfg)
        .withColumn(
            "incidents", F.when(F.size("incidents") > 0, F.col("incidents")).otherwise(fallback)
        )
        .select("url", "candidate_no", "incidents")
    )


def best_candidate(found: DataFrame) -> DataFrame:
    """The container with most incidents, the earlier one on ties.

    The containers of a page come from one task, so the map side of the
    aggregate already leaves one row per page for the shuffle. Containers
    without incidents are dropped after it: a filter in front would be pushed
    below the segmentation and repeat it.
    """
    rank = F.struct(F.size("incidents").alias("n"), (-F.col("candidate_no")).alias("first"))
    return (
        found.groupBy("url")
        .agg(F.max_by(F.struct("candidate_no", "incidents"), rank).alias("best"))
        .select("url", "best.candidate_no", "best.incidents")
        .filter(F.size("incidents") > 0)
    )


def unfold(df: DataFrame, column: str, position: str, value: str) -> DataFrame:
    """One row per element of a computed array.

    The outer form, with its one row for an empty array taken out afterwards:
    the plain form lets Spark infer a filter on the array's size, which is
    pushed below whatever computes the array and repeats it.
    """
    kept = [c for c in df.columns if c != column]
    unfolded = df.select(*kept, F.posexplode_outer(column).alias(position, value))
    return unfolded.filter(F.col(position).isNotNull())


def explode_incidents(df: DataFrame, column: str = "incidents") -> DataFrame:
    """One row per incident, numbered in page order."""
    kept = [c for c in df.columns if c not in (column, "candidate_no")]
    return unfold(df.select(*kept, column), column, "incident_no", "incident").select(
        *kept, "incident_no", "incident.incident_type", "incident.incident_text"
    )


def skipped_pages(pages: DataFrame, best: DataFrame) -> DataFrame:
    """Pages in which no container gave an incident."""
    return pages.select("url").distinct().join(best.select("url"), "url", "left_anti")
