from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from blotterflow.operators import dedup as K
from blotterflow.operators import normalize as N

KIND = (
    "beat_url string, beat_title string, beat_published_at string, date_range_raw string, "
    "incident_dates array<string>, is_multi_date_beat boolean, incident_type string, incident_text string, "
    "raw_text_hash string, scraped_at timestamp, location_zone string, location_confidence string, "
    "location_source string, normalized boolean"
)


def doc(**changes):
    base = {
        "beat_url": "https://log.example/page/77",
        "beat_title": "Police Beat - 11/07/2019 - 11/09/2019",
        "beat_published_at": "2019-11-12",
        "date_range_raw": "11/07/2019 - 11/09/2019",
        "incident_dates": ["2019-11-07", "2019-11-08", "2019-11-09"],
        "is_multi_date_beat": True,
        "incident_type": "Lost Pet",
        "incident_text": "A parrot flew off near the duck pond.",
        "raw_text_hash": "k77",
        "scraped_at": datetime(2019, 11, 12, 8, 30),
        "location_zone": "SERVICE_SUPPORT",
        "location_confidence": "MEDIUM",
        "location_source": "llm",
        "normalized": False,
    }
    return tuple({**base, **changes}.values())


def frame(spark, *docs):
    return spark.createDataFrame(list(docs), KIND)


def test_document_splits_in_three(spark):
    raw = frame(spark, doc())
    beat, incident = N.to_beats(raw).first(), N.to_incidents(raw).first()
    assert beat.beat_url == "https://log.example/page/77" and beat.published_at == "2019-11-12"
    assert incident.raw_text_hash == "k77" and incident.location_zone == "SERVICE_SUPPORT"
    assert (incident.earliest_date, incident.latest_date) == (date(2019, 11, 7), date(2019, 11, 9))
    assert incident.is_multi_date_beat
    assert "location_reasoning" not in incident.asDict()
    assert [r.incident_date.day for r in N.to_dates(raw).orderBy("incident_date").collect()] == [7, 8, 9]


def test_spans_of_odd_date_lists(spark):
    raw = frame(
        spark,
        doc(raw_text_hash="k1", incident_dates=["2021-02-03", None, "", "2021-02-03"], beat_published_at=""),
        doc(raw_text_hash="k2", incident_dates=[], is_multi_date_beat=None),
        doc(raw_text_hash="k3", incident_dates=["2021-02-28"]),
    )
    spans = {r.raw_text_hash: (r.earliest_date, r.latest_date, r.is_multi_date_beat) for r in N.to_incidents(raw).collect()}
    day, last = date(2021, 2, 3), date(2021, 2, 28)
    assert spans == {"k1": (day, day, True), "k2": (None, None, False), "k3": (last, last, True)}
    assert sorted(tuple(r) for r in N.to_dates(raw).collect()) == [("k1", day), ("k3", last)]
    assert N.to_beats(raw).filter("published_at IS NULL").count() == 1


def test_pending_and_mark(spark):
    raw = frame(
        spark, doc(raw_text_hash="a"), doc(raw_text_hash="b", normalized=True), doc(raw_text_hash="c", location_zone=None)
    )
    ready = raw.filter(N.is_ready())
    assert [r.raw_text_hash for r in ready.collect()] == ["a"]
    marked = {r.raw_text_hash: r.normalized for r in N.mark_normalized(raw, ready).collect()}
    assert marked == {"a": True, "b": True, "c": False}


def test_a_normalizing_run(spark):
    raw = frame(
        spark,
        doc(raw_text_hash="a", beat_title="new"),
        doc(raw_text_hash="b", incident_dates=[]),
        doc(raw_text_hash="c", normalized=True),
        doc(raw_text_hash="d", location_zone=None),
    )
    old = frame(spark, doc(raw_text_hash="b", scraped_at=datetime(2020, 1, 1), beat_title="old"))
    tables = {"beats": N.to_beats(old), "incidents": N.to_incidents(old), "incident_dates": N.to_dates(old)}
    new = N.normalize_pending(raw, tables)
    assert {r.raw_text_hash: r.normalized for r in new["raw_incidents"].collect()} == {
        "a": True, "b": True, "c": True, "d": False,
    }
    assert {r.raw_text_hash for r in new["incidents"].collect()} == {"a", "b"}
    assert {r.raw_text_hash for r in new["incident_dates"].collect()} == {"a"}
    assert [r.beat_title for r in new["beats"].collect()] == ["new"]
    copies = frame(spark, *[doc(raw_text_hash=h, beat_url=f"{h}{i}") for h in ("x", "y") for i in range(3)], doc(raw_text_hash=None))
    none = {n: t.limit(0) for n, t in tables.items()}
    first = N.normalize_pending(copies, none, limit=1)
    assert {r.beat_url for r in first["beats"].collect()} == {"x0", "x1", "x2"}
    assert first["raw_incidents"].filter("normalized").count() == 3
    second = N.normalize_pending(first["raw_incidents"], {n: first[n] for n in none}, limit=1)
    assert second["beats"].count() == 6 and second["raw_incidents"].filter("normalized").count() == 6
    capped = N.normalize_pending(raw, tables, limit=1)
    assert capped["raw_incidents"].filter("normalized").count() == 2


def test_upsert_and_children(spark):
    old = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2), ("c", 2), ("b", 3)], "k string, v int")
    assert {tuple(r) for r in K.upsert(old, new, "k", ["v"]).collect()} == {("a", 1), ("b", 3), ("c", 2)}
    kids = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("d", 9)], "k string, v int")
    fresh = spark.createDataFrame([("b", 3)], "k string, v int")
    touched = spark.createDataFrame([("b",), ("d",), ("b",)], "k string")
    assert {tuple(r) for r in K.replace_children(kids, fresh, touched, "k").collect()} == {("a", 1), ("b", 3)}


def test_insert_is_idempotent(spark):
    landed = spark.createDataFrame([("a", 0)], "k string, n int")
    batch = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2), ("c", 4)], "k string, n int")
    fresh = K.new_rows(landed, batch, "k", ["n"])
    assert {tuple(r) for r in fresh.collect()} == {("b", 2), ("c", 4)}
    assert tuple(K.insert_counts(landed, batch, "k").first()) == (2, 2, 0)
    both = landed.unionByName(fresh)
    assert K.new_rows(both, batch, "k", ["n"]).count() == 0
    assert tuple(K.insert_counts(both, batch, "k").first()) == (0, 4, 0)
    assert tuple(K.insert_counts(both, batch.limit(0), "k").first()) == (0, 0, 0)
    strays = batch.unionByName(spark.createDataFrame([(None, 7), (None, 8)], "k string, n int"))
    assert tuple(K.insert_counts(landed, strays, "k").first()) == (2, 2, 2)
    assert K.new_rows(landed, strays, "k", ["n"]).filter("k IS NULL").count() == 0


def test_one_key_may_hold_most_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.col("id").alias("n")
    )
    first = K.first_seen(rows, ["k"], ["n"])
    assert first.count() == 10_001 and first.filter("k = 'hot'").first().n == 1
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_stored_rows_that_are_alone_with_their_key_are_not_grouped(spark, tmp_path, monkeypatch):
    rows = [(f"k{i}", i % 3, f"v{i}") for i in range(50)] + [("k7", 9, "late"), ("k8", -1, "early"), (None, 1, "a"), (None, 2, "b")]
    spark.createDataFrame(rows, "key string, at int, value string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    wanted = sorted(map(str, K.last_seen(df, ["key"], ["at"]).collect()))
    got = K.last_seen_stored(df, ["key"], ["at"], f"{tmp_path}/recurring")
    assert sorted(map(str, got.collect())) == wanted and len(wanted) == 51
    met = spark.read.parquet(f"{tmp_path}/recurring")
    assert met.count() == 3  # k7, k8 and NULL
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti, BuildRight" in plan and "LeftSemi, BuildRight" in plan and "SortMergeJoin" not in plan
    monkeypatch.setattr(K, "FEW_RECURRING", 2)
    assert sorted(map(str, K.last_seen_stored(df, ["key"], ["at"], f"{tmp_path}/many").collect())) == wanted

