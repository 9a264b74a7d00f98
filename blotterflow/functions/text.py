"""Text column functions.

Java's plain ``\\s`` is ASCII only and ``(?U)\\s`` still leaves the four
information separators U+001C-U+001F, so both are spelled out.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotterflow.config import DATE_PATTERN, DEFAULT, PipelineConfig

WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
# fixed values: the dash code points folded to "-"
DASHES = "‐‑‒–—―−"
# fixed values: characters that end a line
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"


def collapse_ws(c: Column) -> Column:
    """Every whitespace run becomes one space, ends are trimmed."""
    return F.trim(F.regexp_replace(c, WHITESPACE, " "))


def fold_text(c: Column) -> Column:
    """Dashes to ``-``, then T1."""
    return collapse_ws(F.translate(c, DASHES, "-" * len(DASHES)))


def blank_to_null(c: Column) -> Column:
    """Trimmed value, or NULL when nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def empty_to_null(c: Column) -> Column:
    """NULL for the empty string only."""
    return F.nullif(c, F.lit(""))


def incident_hash(url: Column, incident_type: Column, text: Column) -> Column:
    """SHA-256 of the three fields; NULL if any is NULL."""
    return F.sha2(F.concat(url, F.lit("\n"), incident_type, F.lit("\n"), text), 256)


def clean_type(c: Column) -> Column:
    """T1, then all trailing colons off."""
    return F.rtrim(collapse_ws(c), F.lit(":"))


def split_lines(c: Column) -> Column:
    return F.split(c, LINE_BREAK)


def has_marker(c: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    return c.rlike("(?iU)" + cfg.marker_pattern)


def is_noise_line(c: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """Starts with a template-setting prefix (case-sensitive)."""
    return reduce(lambda a, b: a | b, [c.startswith(p) for p in cfg.noise_prefixes])


def is_title_or_date_line(c: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """The report's own title line."""
    return F.lower(c).startswith(cfg.title_prefix) | c.rlike("(?iU)" + cfg.title_pattern)


def is_plausible_incident_type(c: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """Could the line be an incident type at all."""
    return (
        (F.length(c) > 0)
        & (F.length(c) <= cfg.max_type_chars)
        & (F.size(F.split(F.trim(c), " ")) <= cfg.max_type_words)
        & c.rlike("[A-Za-z]")
        & ~c.rlike(DATE_PATTERN)
        & ~has_marker(c, cfg)
        & ~is_title_or_date_line(c, cfg)
    )


def is_strict_heading_candidate(c: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """T10, no sentence end, and no word that opens a narrative."""
    first_word = F.lower(F.regexp_replace(F.substring_index(c, " ", 1), "[^A-Za-z']+", ""))
    # the sentence end is the cheapest to see, and most lines have one
    return (
        ~(c.endswith(".") | c.endswith("?") | c.endswith("!"))
        & is_plausible_incident_type(c, cfg)
        & ~first_word.isin(*cfg.narrative_start_words)
    )
