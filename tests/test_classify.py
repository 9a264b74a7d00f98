from __future__ import annotations

import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from blotterflow.config import DEFAULT, PipelineConfig
from blotterflow.functions import rules as R
from blotterflow.operators import classify as C


def lookup(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, t string")
    rows = C.with_lookup(df, F.col("t")).orderBy("n").collect()
    return [tuple(r.hit) if r.hit else None for r in rows]


GOLDEN = {
    "an alarm panel beeped in the HBLL": ("ACADEMIC_CORE", "landmark"),
    "a stroller by the Wilkinson Student Center": ("STUDENT_SERVICES", "landmark"),
    "banners taken from LaVell Edwards Stadium": ("STADIUM_AREA", "landmark"),
    "a loud bang at Wymount Terrace": ("WYVIEW_WYMOUNT", "landmark"),
    "a van blocked the gate of the MTC": ("MTC", "landmark"),
    "paint behind the University Press Building": ("SERVICE_SUPPORT", "landmark"),
    "a tenant of the Riviera Apartments": ("OFF_CAMPUS", "landmark"),
    "an argument over seats in the Marriott Center": ("STADIUM_AREA", "landmark"),
    "a timer went off in HR #12": ("DORMS_HERITAGE", "landmark"),
    "a cracked window of Chipman Hall": ("DORMS_HELAMAN", "landmark"),
    "a cart rolled into the Food‑to‑Go Building": ("SERVICE_SUPPORT", "landmark"),
    "a trailer in Lot #41": ("DORMS_HELAMAN", "lot"),
    "LOT 0041": ("DORMS_HELAMAN", "lot"),
    "a kitten was rescued": None,
    "a boat in Lot 999": None,
    "Lot 999, then Lot 41": None,
    "Lot 99999999999999999999": None,
    "a lot of noise": None,
    "": None,
}


def test_lookup_golden(spark):
    got = lookup(spark, list(GOLDEN))
    assert [g and g[:2] for g in got] == list(GOLDEN.values())


def test_reasoning_keeps_the_matched_case(spark):
    got = lookup(spark, ["near LAW  School and the HbLL", "in lot # 41 at noon"])
    assert got == [("BUSINESS_SOUTH", "landmark", "matched 'LAW School'"), ("DORMS_HELAMAN", "lot", "parking Lot 41")]


def test_rule_order_beats_text_order(spark):
    assert lookup(spark, ["the HBLL, later Heritage Halls"])[0][0] == "DORMS_HERITAGE"


def test_gates_are_part_of_every_match():
    for pattern, _ in DEFAULT.place_rules:
        gate = R.gate_literal(pattern)
        sample = re.sub(r"\\s[*+?]?", " ", pattern.replace(r"\b", ""))
        sample = re.sub(r"\[(.)[^\]]*\]\??", r"\1", sample)
        sample = re.sub(r"\(([^|)]*)(\|[^)]*)?\)\??", r"\1", sample).replace(r"\.?", "").replace("  ", " ")
        match = re.search(pattern, sample, re.IGNORECASE)
        assert match and gate in match.group(0).lower()


@pytest.mark.parametrize(
    "pattern, gate",
    [("a|bc", ""), ("ab?cde+f", "cd"), ("x{2}y", ""), ("(?:a|b)cde", "cde"), ("(?!x)abc", ""), ("(?x)a b", "")],
)
def test_unsure_patterns_get_no_wrong_gate(pattern, gate):
    assert R.gate_literal(pattern) == gate


def test_first_rule_equals_a_plain_search(spark):
    rng = random.Random(7)
    words = "heritage HR # cone Smith field house west view building off campus Off-Campus mtc escx esc law school food to go k K ſcob".split()
    texts = [" ".join(rng.choices(words, k=6)) for _ in range(400)]
    compiled = [(re.compile(p, re.IGNORECASE)) for p, _ in DEFAULT.place_rules]
    want = [next((i for i, c in enumerate(compiled) if c.search(t)), None) for t in texts]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    got = df.select("n", R.first_rule(DEFAULT.place_rules, F.col("t")).alias("r")).orderBy("n").collect()
    assert [r.r for r in got] == want


def test_named_places(apply):
    cases = {
        "a lamp fell in the Ellsworth Building": True,
        "staff working late in the area": False,
        "a glove near Building": True,
        "the building": False,
        "Old Field House": True,
        "Buildings": False,
    }
    assert apply(list(cases), R.names_place) == list(cases.values())


def test_categories_in_order(apply):
    cases = {
        "Found Property": "Service",
        "Injury Accident": "Medical",
        "Vehicle Burglary": "Traffic",
        "FIRE ALARM": "Alarm",
        "Hit and Run": "Traffic",
        "Trespassing": "Conduct/Crime",
        "Noise": "Other",
    }
    assert apply(list(cases), R.category) == list(cases.values())


def fixed(zone):
    def model(texts: pd.Series) -> pd.Series:
        return pd.Series([zone] * len(texts))

    return model


def classify(spark, texts, model=None):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, incident_text string")
    rows = C.classify(df, model=model).orderBy("n").collect()
    return [tuple(r.location) for r in rows]


def test_without_a_model_misses_are_unknown(spark):
    assert classify(spark, ["the caller gave no place", None]) == [("UNKNOWN", "none", C.NO_MODEL_REASON)] * 2


def test_guard(spark):
    texts = ["lost on an engineering tour", "a lift stuck in the Kimball Tower", "a freezer in the Widtsoe Building"]
    assert [r[:2] for r in classify(spark, texts, fixed(" engineering_north\n"))] == [
        ("UNKNOWN", "guardrail"),
        ("ACADEMIC_CORE", "landmark"),
        ("ENGINEERING_NORTH", "llm"),
    ]
    assert classify(spark, texts[:1], fixed("MTC"))[0][2] == "model proposed MTC but text names no explicit place"
    assert classify(spark, texts[2:], fixed("NORTH_QUAD")) == [("UNKNOWN", "llm", C.NO_PLACE_REASON)]


def test_a_hit_never_reaches_the_model(spark, tmp_path):
    log = str(tmp_path / "seen")

    def model(texts: pd.Series) -> pd.Series:
        with open(log, "a") as out:
            out.writelines(t + "\n" for t in texts)
        return pd.Series(["UNKNOWN"] * len(texts))

    classify(spark, ["a beeping panel in the HBLL", "nothing‑named", "in Lot 41"], model)
    assert set(open(log).read().splitlines()) == {"nothing-named"}


def test_a_failing_row_is_unknown_and_the_others_stand(spark):
    def model(texts: pd.Series) -> pd.Series:
        if texts.str.contains("bad").any():
            raise RuntimeError("no answer")
        return pd.Series(["MTC"] * len(texts))

    got = classify(spark, ["bad Widtsoe Building", "good Widtsoe Building"], model)
    assert [g[:2] for g in got] == [("UNKNOWN", "llm"), ("MTC", "llm")]


def raw(spark, rows):
    return spark.createDataFrame(
        rows,
        "raw_text_hash string, incident_text string, location_zone string, location_confidence string, "
        "location_source string, location_reasoning string",
    )


def test_pending_rows_only(spark):
    df = raw(
        spark,
        [("a", "at the HBLL", None, None, None, None), ("b", "at the HBLL", "MTC", "MEDIUM", "llm", "said so"), ("c", None, None, None, None, None)],
    )
    got = {r.raw_text_hash: tuple(r)[2:] for r in C.classify_pending(df).collect()}
    assert got == {
        "a": ("ACADEMIC_CORE", "HIGH", "landmark", "matched 'HBLL'"),
        "b": ("MTC", "MEDIUM", "llm", "said so"),
        "c": ("UNKNOWN", "NONE", "none", C.NO_MODEL_REASON),
    }


def test_run_cap_takes_the_first_keys(spark):
    df = raw(spark, [(k, "x", None, None, None, None) for k in "dbca"] + [("0", "x", "MTC", "HIGH", "lot", "")])
    done = C.classify_pending(df, limit=2).filter("location_source = 'none'")
    assert {r.raw_text_hash for r in done.collect()} == {"a", "b"}


def test_confidence_and_counts(spark, apply):
    assert apply(["landmark", "lot", "llm", "guardrail", "none", "new", None], R.confidence) == [
        "HIGH", "HIGH", "MEDIUM", "NONE", "NONE", "NONE", "NONE",
    ]
    df = spark.createDataFrame([("lot",), ("lot",), ("none",)], "location_source string")
    assert {tuple(r) for r in C.source_counts(df).collect()} == {("lot", 2), ("none", 1)}


def test_rules_can_be_replaced(spark):
    cfg = PipelineConfig(place_rules=((r"harbou?r", "PORT"),), lot_zones={7: "PORT"}, zones=("PORT", "UNKNOWN"))
    df = spark.createDataFrame([("the Harbor",), ("lot 7",)], "incident_text string")
    assert {r.location.zone for r in C.classify(df, cfg=cfg).collect()} == {"PORT"}
