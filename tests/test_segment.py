from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from blotterflow.operators import segment as G

# H: heading-like, T: other text, N: title, B: blank
LINES = {
    "H": ["Theft", "Bike Theft:", "Lost Item", "Smoke Alarm", "Welfare Check"],
    "T": ["Officers came by.", "It was returned.", "12345", "The owner was told"],
    "N": ["Police Beat - 01/02/2024", "police beat"],
    "B": [""],
}


def flat_form(kinds, lines):
    """Runs of the plain rule, written as a scan over (kind, line) pairs."""
    found, head, body = [], None, []
    for kind, line in [(k, x) for k, x in zip(kinds, lines) if k in "HT"] + [("end", None)]:
        opens = kind == "H" and (head is None or body)
        if (opens or kind == "end") and head is not None and body:
            found.append((head.rstrip(":"), " ".join(body)))
        if opens:
            head, body = line, []
        elif head is not None:
            body.append(line)
    return found


def block_form(kinds, lines):
    groups = re.finditer(r"[HTN]+", "".join(kinds))
    bodies = [[lines[i] for i in range(*g.span()) if kinds[i] != "N"] for g in groups]
    typed = [(b[0].rstrip(":"), " ".join(b[1:])) for b in bodies if len(b) > 1]
    return [(t, x) for t, x in typed if t != "12345"]


def test_forms_equal_brute_force(spark):
    rng = random.Random(3)
    cases = []
    for n in range(1500):
        kinds = rng.choices("HTNB", weights=(4, 4, 1, 3), k=rng.randint(0, 14))
        cases.append((n, kinds, [rng.choice(LINES[k]) for k in kinds]))
    df = spark.createDataFrame([(n, "\n".join(lines)) for n, _, lines in cases], "n int, text string")
    lines = G.with_clean_lines(df, "text")
    got = G.with_flat_incidents(G.with_block_incidents(lines)).withColumn(
        "picked", G.pick_form(F.col("block"), F.col("flat"))
    )
    rows = {r.n: r for r in got.collect()}
    for n, kinds, text in cases:
        block, flat = block_form(kinds, text), flat_form(kinds, text)
        assert [tuple(i) for i in rows[n].block] == block, (kinds, text)
        assert [tuple(i) for i in rows[n].flat] == flat, (kinds, text)
        assert [tuple(i) for i in rows[n].picked] == (flat if len(flat) > len(block) else block)


def clean(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    return G.with_clean_lines(df, "text").first().lines


def test_lines_are_cleaned_in_order(spark):
    text = "\n \na  b\noverrideTextColor=x\n\nc\n\n\nFollow us  on Facebook\nd"
    assert clean(spark, text) == ["a b", "", "c"]
    assert clean(spark, "overrideTextColor= Follow us on Facebook\na") == []
    assert clean(spark, " \n\n") == []


def test_a_long_incident_does_not_overflow(spark):
    text = "Theft\n" + "\n".join(f"Officers noted item {i}." for i in range(200_000))
    df = spark.createDataFrame([(text,)], "text string")
    found = G.segment_lines(G.with_clean_lines(df, "text")).first().incidents
    assert len(found) == 1 and found[0].incident_text.endswith("item 199999.")


def test_long_runs_cost_linear_time(spark):
    text = "Theft\nA bike.\n" + "\n" * 300_000 + ":" * 300_000 + "x\nMore.\n" + "!" * 300_000 + "x\n" + " " * 300_000
    df = spark.createDataFrame([(text,)], "text string")
    found = G.segment_lines(G.with_clean_lines(df, "text")).first().incidents
    assert [i.incident_type for i in found] == ["Theft"]


def test_two_headings_make_one_incident(spark):
    df = spark.createDataFrame([(["Theft", "Lost Item", "It was found."],)], "lines array<string>")
    got = G.with_flat_incidents(df).first().flat
    assert [tuple(i) for i in got] == [("Theft", "Lost Item It was found.")]


def test_best_candidate_prefers_more_then_earlier(spark):
    kind = "url string, candidate_no int, incidents " + G.INCIDENTS_TYPE
    one, two = [("", "x")], [("", "x"), ("", "y")]
    df = spark.createDataFrame(
        [("a", 0, one), ("a", 1, two), ("a", 2, two), ("b", 0, []), ("c", 3, one), ("c", 1, one)], kind
    )
    best = G.best_candidate(df)
    assert {(r.url, r.candidate_no) for r in best.collect()} == {("a", 1), ("c", 1)}
    pages = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "url string")
    assert {r.url for r in G.skipped_pages(pages, best).collect()} == {"b", "d"}
    assert G.explode_incidents(best).count() == 3
