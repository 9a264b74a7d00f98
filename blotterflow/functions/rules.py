"""Ordered rules.

Trying rules over long text is CPU-bound: a text that names no place is tried
against every pattern. Each pattern therefore gets a *gate*, a literal its
matches must contain, tested by a plain substring search on a lower-cased copy
of the text. The pattern itself runs only when its gate holds, so a miss costs
one substring search per rule instead of one regex scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotterflow.config import DEFAULT, ZONE_ATTRIBUTES, PipelineConfig

FLAGS = "(?iU)"
LOT_PATTERN = FLAGS + r"\blot\s*#?\s*([0-9]+)"
# letters that fold to ASCII under case-insensitive matching but not by lower()
_FOLD_FROM, _FOLD_TO = "ſİıK", "siik"


# the pattern pieces a gate can be read from; anything else means no gate
_PIECE = re.compile(
    r"(?P<literal>[A-Za-z0-9 '#&-])(?P<repeat>[?*+])?"
    r"|(?:\\[bsdw.]|\.|\[[^\]]*\]|\((?!\?[^:])[^()]*\))[?*+]?"
)


def gate_literal(pattern: str) -> str:
    """The longest literal every match of ``pattern`` contains ('' if unsure)."""
    runs, at = [""], 0
    while at < len(pattern):
        piece = _PIECE.match(pattern, at)
        if piece is None:
            return ""
        if piece["literal"] and not piece["repeat"]:
            runs[-1] += piece["literal"].lower()
        else:
            runs.append("")
        at = piece.end()
    return max(runs, key=len)


def folded(text: Column) -> Column:
    """Lower-cased copy of a text for the gates."""
    return F.lower(F.translate(text, _FOLD_FROM, _FOLD_TO))


def first_rule(rules, text: Column) -> Column:
    """Zero-based position of the first rule that matches, or NULL.

    Patterns are literals, so each is compiled once, and the rules are tried in order
    until one matches. They stand inside a lambda over a one-element array, which binds
    the text and its folded copy once and keeps ninety branches out of generated code.
    """
    bound = F.array(F.struct(text.alias("text"), folded(text).alias("low")))

    def walk(x: Column) -> Column:
        low, whole = x["low"], x["text"]

        def tried(position: int, pattern: str) -> Column:
            matches = whole.rlike(FLAGS + pattern)
            gate = gate_literal(pattern)
            return F.when(low.contains(gate) & matches if gate else matches, position)

        return F.coalesce(*[tried(i, pattern) for i, (pattern, _) in enumerate(rules)])

    return F.get(F.transform(bound, walk), 0)


def rule_value(rules, position: Column) -> Column:
    """The zone or category a rule position stands for."""
    return F.get(F.lit([value for _, value in rules]), position)


def rule_matched_text(rules, position: Column, text: Column) -> Column:
    """The matched text in its original case."""
    patterns = F.lit([FLAGS + pattern for pattern, _ in rules])
    return F.regexp_substr(text, F.get(patterns, position))


def lot_number(text: Column) -> Column:
    """The number of the first named lot only."""
    return F.regexp_extract(text, LOT_PATTERN, 1).try_cast("bigint")


def lot_zone(number: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    pairs = [F.lit(x) for lot, zone in cfg.lot_zones.items() for x in (lot, zone)]
    return F.try_element_at(F.create_map(*pairs).cast("map<bigint,string>"), number)


def names_place(text: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """C4: a capitalized place noun on word boundaries; case-sensitive."""
    return text.rlike(r"(?U)\b(?:" + "|".join(cfg.place_nouns) + r")\b")


def category(incident_type: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """First matching category, else Other."""
    position = first_rule(cfg.category_rules, incident_type)
    return F.coalesce(rule_value(cfg.category_rules, position), F.lit("Other"))


def confidence(source: Column, cfg: PipelineConfig = DEFAULT) -> Column:
    """Tier of the layer that decided."""
    pairs = [F.lit(x) for item in cfg.confidence.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), source), F.lit("NONE"))


def zone_attributes(zone: Column) -> list[Column]:
    """Label and groupings; a NULL zone is labelled but has NULL flags."""

    def members(position: int) -> list[str]:
        return [name for name, attrs in ZONE_ATTRIBUTES.items() if attrs[position]]

    off_site = [n for n, attrs in ZONE_ATTRIBUTES.items() if not attrs[3]]
    pairs = [F.lit(x) for name, attrs in ZONE_ATTRIBUTES.items() for x in (name, attrs[0])]
    return [
        F.coalesce(F.try_element_at(F.create_map(*pairs), zone), F.lit("Unknown")).alias("zone_label"),
        zone.isin(*members(1)).alias("is_residential"),
        zone.isin(*members(2)).alias("is_academic"),
        (~zone.isin(*off_site)).alias("is_on_campus"),
        (zone == "UNKNOWN").alias("is_unknown"),
    ]
