from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from blotterflow.functions import text as X


def test_whitespace_of_every_kind_collapses(apply):
    values = ["a   b\n c", " x y　", "\x1ca\x1f\x1db\x85", "", "\t\n"]
    assert apply(values, X.collapse_ws) == ["a b c", "x y", "a b", "", ""]


def test_dashes_fold(apply):
    assert apply(["Food‑to‑Go", "a — b", "1−2"], X.fold_text) == ["Food-to-Go", "a - b", "1-2"]


def test_blank_and_empty_to_null(apply):
    assert apply([" x ", "  ", "", None], X.blank_to_null) == ["x", None, None, None]
    assert apply([" x ", "  ", "", None], X.empty_to_null) == [" x ", "  ", None, None]


def test_type_loses_trailing_colons_only(apply):
    assert apply(["Theft::", " Theft :  ", "a:b", ":"], X.clean_type) == ["Theft", "Theft ", "a:b", ""]


def test_hash_is_the_digest_of_three_lines(spark):
    row = spark.sql("SELECT 'u' a, 'Théft' b, 'x y' c").select(
        X.incident_hash(F.col("a"), F.col("b"), F.col("c")).alias("h")
    )
    assert row.first().h == hashlib.sha256("u\nThéft\nx y".encode()).hexdigest()
    null = spark.sql("SELECT 'u' a, CAST(NULL AS STRING) b, 'x' c")
    assert null.select(X.incident_hash(F.col("a"), F.col("b"), F.col("c"))).first()[0] is None


def test_lines_split_like_text_lines(apply):
    value = "a\r\nb\rc\nd\x0be\x0cf\x1cg\x85h i"
    assert apply([value], X.split_lines) == [value.splitlines()]


def test_noise_lines(apply):
    values = ["overrideTextColor=red", " overrideTextColor=", "overridetextcolor=", "", "data-content-type=x"]
    assert apply(values, X.is_noise_line) == [True, False, False, False, True]


def test_title_lines(apply):
    values = ["Police Beat", "POLICE BEAT news", "The Police Beat: 01/02/2024", "The police beat", "", "police  beat • x"]
    assert apply(values, X.is_title_or_date_line) == [True, True, True, False, False, True]


def test_plausible_types(apply):
    cases = {
        "Theft": True,
        "": False,
        "x" * 100: True,
        "x" * 101: False,
        "Follow us on Facebook": False,
        "Police Beat - x": False,
        "Theft 01/02/2024": False,
        "123 456": False,
        "a b c d e f g h i j": True,
        "a b c d e f g h i j k": False,
        "a b c d e f g h i j ": True,
        "Éé": False,
    }
    assert apply(list(cases), X.is_plausible_incident_type) == list(cases.values())


def test_strict_headings(apply):
    cases = {
        "Theft": True,
        "Theft.": False,
        "Theft?": False,
        "Officers Arrived": False,
        "“The” door": False,
        "Lost Item:": True,
        "42 Bikes": True,
        "They're Gone": True,
        "": False,
    }
    assert apply(list(cases), X.is_strict_heading_candidate) == list(cases.values())
