from __future__ import annotations

from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.sql import functions as F

from blotterflow import schemas as S
from blotterflow.session import shared_dir
from blotterflow.sources import store as store_module
from blotterflow.sources.landed_keys import PREFIX_BITS, prefix
from blotterflow.sources.store import IncidentStore
from blotterflow.streaming.catchup import land_batch, run_available


def doc(key, url="u1", text="at the HBLL", title="Police Beat", day=1, at=1, dates=1):
    return (
        url, title, "", "r", [date(2024, 1, day + i) for i in range(dates)], dates > 1, "Theft", text, key,
        datetime(2024, 2, at), None, None, None, None, False,
    )


def frame(spark, *docs):
    return spark.createDataFrame(list(docs), S.RAW_INCIDENTS)


@pytest.fixture
def store(spark, tmp_path):
    return IncidentStore(spark, str(tmp_path / "store"))


def keys(df):
    return sorted(r.raw_text_hash for r in df.collect())


def test_batches_land_once(spark, store):
    land_batch(store, frame(spark, doc("a"), doc("b", "u2"), doc("a")))
    land_batch(store, frame(spark, doc("b", "u2"), doc("c", "u2", "in Lot 999")))
    assert keys(store.incidents()) == ["a", "b", "c"]
    commits = sorted(store.commits().filter("batch_id >= 0").collect(), key=lambda r: r.batch_id)
    assert [(r.inserted, r.skipped, r.rejected) for r in commits] == [(2, 1, 0), (1, 1, 0)]
    assert [sum(r.sources.values()) for r in commits] == [2, 1]
    zones = {r.raw_text_hash: r.location_zone for r in store.incidents().collect()}
    assert zones == {"a": "ACADEMIC_CORE", "b": "ACADEMIC_CORE", "c": "UNKNOWN"}
    assert store.raw_incidents().filter("NOT normalized").count() == 0
    assert store.beats().count() == 2 and store.incident_dates().count() == 3


def test_repeating_a_batch_changes_nothing(spark, store):
    batch = frame(spark, doc("a", dates=2), doc("b", "u2"))
    land_batch(store, batch)
    before = {name: sorted(map(str, df.collect())) for name, df in store.tables().items()}
    land_batch(store, batch)
    assert {name: sorted(map(str, df.collect())) for name, df in store.tables().items()} == before
    assert store.raw_incidents().count() == 2


def test_a_run_that_dies_before_its_commit_is_repeated(spark, store, monkeypatch):
    land_batch(store, frame(spark, doc("a")))
    real = IncidentStore._write

    def dying(self, df, name, batch_id, mode="overwrite"):
        if name == "incident_dates":
            raise RuntimeError("lost")
        real(self, df, name, batch_id, mode)

    monkeypatch.setattr(store_module.IncidentStore, "_write", dying)
    with pytest.raises(RuntimeError):
        land_batch(store, frame(spark, doc("b"), doc("x")))
    assert keys(store.incidents()) == ["a"] and keys(store.raw_incidents()) == ["a"]
    monkeypatch.undo()
    land_batch(store, frame(spark, doc("b")))
    assert keys(store.incidents()) == ["a", "b"] and keys(store.incident_dates()) == ["a", "b"]


def test_later_batches_win_and_replace_children(spark, store, tmp_path):
    store.write_batch(frame(spark, doc("a", title="old", dates=3), doc("b", dates=2)))
    store.write_batch(frame(spark, doc("a", title="new", day=9, at=2, dates=0)))
    for current in (store, store.compact_to(str(tmp_path / "compact"))):
        ends = {r.raw_text_hash: r.earliest_date for r in current.incidents().collect()}
        assert ends == {"a": None, "b": date(2024, 1, 1)}
        assert keys(current.incident_dates()) == ["b", "b"]
        assert [r.beat_title for r in current.beats().collect()] == ["new"]


def test_catch_up_runs_see_only_new_files(spark, store, tmp_path):
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    asked = tmp_path / "asked"

    def model(texts: pd.Series) -> pd.Series:
        with open(asked, "a") as out:
            out.writelines(t + "\n" for t in texts)
        return pd.Series(["OFF_CAMPUS"] * len(texts))

    frame(spark, doc("a"), doc("b", text="the Widtsoe Building")).coalesce(1).write.parquet(landing)
    run_available(spark, landing, store, checkpoint, model=model)
    run_available(spark, landing, store, checkpoint, model=model)
    frame(spark, doc("b", text="the Widtsoe Building"), doc("c", text="a trip")).write.mode("append").parquet(landing)
    run_available(spark, landing, store, checkpoint, model=model)
    got = {r.raw_text_hash: (r.location_zone, r.location_source) for r in store.incidents().collect()}
    assert got == {"a": ("ACADEMIC_CORE", "landmark"), "b": ("OFF_CAMPUS", "llm"), "c": ("UNKNOWN", "guardrail")}
    assert sorted(asked.read_text().splitlines()) == ["a trip", "the Widtsoe Building"]
    assert store.commits().filter("batch_id >= 0").count() == 2
    # a lost checkpoint reads everything again and lands nothing twice
    run_available(spark, landing, store, checkpoint + "-new", model=model)
    assert keys(store.raw_incidents()) == ["a", "b", "c"]


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_documents_without_a_hash_are_rejected_and_counted(spark, store):
    land_batch(store, frame(spark, doc("a"), doc(None), doc(None)))
    (row,) = store.commits().filter("batch_id >= 0").collect()
    assert (row.inserted, row.skipped, row.rejected) == (1, 0, 2)
    assert keys(store.raw_incidents()) == ["a"]


def scans(df):
    """The partition filters of each scan of the plan."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    return [leaves.apply(i).partitionFilters().mkString(" ") for i in range(leaves.size())]


def test_a_batch_reads_only_its_own_prefixes_of_committed_batches(spark, store):
    land_batch(store, frame(spark, *[doc(f"k{i}") for i in range(40)]))
    land_batch(store, frame(spark, doc("k3"), doc("x")))
    batch = frame(spark, doc("k3"), doc("k7"), doc("new"))
    prefixes = sorted(r.p for r in batch.select(prefix("raw_text_hash").alias("p")).distinct().collect())
    known = store.landed_keys(prefixes)
    (filters,) = scans(known)
    assert all(str(p) in filters for p in prefixes) and "prefix" in filters and "batch_id" in filters
    files = {r.f.rsplit("prefix=", 1)[1].split("/")[0] for r in known.select(F.input_file_name().alias("f")).collect()}
    assert files and files <= {str(p) for p in prefixes}
    assert {"k3", "k7"} <= set(keys(known)) and len(keys(known)) < 20
    assert store.landed_keys([]).count() == 0 and store.landed_keys(range(1 << PREFIX_BITS)).count() == 41
    (filters,) = scans(store.committed("incidents"))
    assert "batch_id" in filters and "1" in filters


def contents(store):
    tables = {**store.tables(), "raw": store.raw_incidents()}
    return {name: sorted(map(str, df.select(*sorted(df.columns)).collect())) for name, df in tables.items()}


def layers(store):
    total: dict[str, int] = {}
    for row in store.commits().filter("batch_id >= 0").collect():
        for layer, n in row.sources.items():
            total[layer] = total.get(layer, 0) + n
    return total


def test_capped_runs_end_where_one_uncapped_run_does(spark, tmp_path):
    drops = [
        [doc("b", "u1", title="one"), doc("a", "u1", title="three", at=3), doc("d", "u2", "in Lot 41")],
        [doc("a", "u1", title="again"), doc("c", "u1", title="two", dates=2), doc("e", "u2", "nowhere"), doc(None)],
    ]

    def model(texts: pd.Series) -> pd.Series:
        return pd.Series(["MTC"] * len(texts))

    landing = str(tmp_path / "landing")
    for drop in drops:
        frame(spark, *drop).coalesce(1).write.mode("append").parquet(landing)
    whole = IncidentStore(spark, str(tmp_path / "whole"))
    run_available(spark, landing, whole, str(tmp_path / "c1"), model=model, files_per_batch=1)
    capped = IncidentStore(spark, str(tmp_path / "capped"))
    waiting = []
    for limit in (2, 1, 1, 5):
        run_available(spark, landing, capped, str(tmp_path / "c2"), model=model, files_per_batch=1, limit=limit)
        waiting.append(capped.waiting().count())
        assert waiting[-1] == capped.last_commit().waiting
        assert len(keys(capped.raw_incidents())) == 5
    assert waiting == [3, 2, 1, 0]
    assert contents(capped) == contents(whole) and layers(capped) == layers(whole)
    inserted = [sum(r.inserted for r in s.commits().filter("batch_id >= 0").collect()) for s in (whole, capped)]
    assert inserted == [5, 5]
    # nothing is new and nothing waits: no further batch
    before = capped.next_batch_id()
    run_available(spark, landing, capped, str(tmp_path / "c2"), model=model, limit=1)
    assert capped.next_batch_id() == before


def test_an_uncapped_run_takes_up_what_waits(spark, store, tmp_path):
    land_batch(store, frame(spark, *[doc(k) for k in "fbdace"]), limit=0)
    assert store.last_commit().waiting == 6 and store.incidents().count() == 0
    assert land_batch(store, frame(spark, doc("a"), doc("g")), limit=4) == 4
    assert keys(store.incidents()) == list("abcd") and keys(store.waiting()) == list("efg")
    moved = store.compact_to(str(tmp_path / "compact"))
    assert contents(moved) == contents(store) and keys(moved.waiting()) == list("efg")
    for current in (store, moved):
        assert land_batch(current, frame(spark, doc("e"))) == 3
        assert keys(current.incidents()) == list("abcdefg") and current.waiting().count() == 0


def test_the_model_sees_each_distinct_text_once(spark, store, tmp_path):
    asked = tmp_path / "asked"

    def model(texts: pd.Series) -> pd.Series:
        with open(asked, "a") as out:
            out.writelines(t + "\n" for t in texts)
        if any("odd" in t for t in texts):
            raise ValueError("no answer")
        return pd.Series(["OFF_CAMPUS"] * len(texts))

    place, odd = "the Widtsoe Building", "the odd Widtsoe Building"
    land_batch(store, frame(spark, *[doc(k, text=place) for k in "abcd"], doc("e", text=odd), doc("f")), model=model)
    land_batch(store, frame(spark, doc("g", text=place + "  "), doc("h", text="a trip"), doc("i", text=odd)), model=model, limit=2)
    land_batch(store, frame(spark), model=model)
    lines = asked.read_text().splitlines()
    # a batch that fails is asked again row by row, but never by a later run
    assert lines.count("a trip") == 1 and lines.count(place) <= 2 and lines.count(odd) <= 2
    got = {r.raw_text_hash: (r.location_zone, r.location_source) for r in store.incidents().collect()}
    assert all(got[k] == ("OFF_CAMPUS", "llm") for k in "abcdg")
    assert got["e"] == got["i"] == ("UNKNOWN", "llm") and got["f"][1] == "landmark" and got["h"] == ("UNKNOWN", "guardrail")
    assert {r.text: r.proposed for r in store.answers().collect()} == {place: "OFF_CAMPUS", odd: "UNKNOWN", "a trip": "OFF_CAMPUS"}


def test_a_landed_batch_is_grouped_by_its_keys_once(spark, store, monkeypatch):
    """New rows hold each key once; writing them doesn't look for the last one again."""
    asked = []
    plain = store_module.last_seen
    monkeypatch.setattr(store_module, "last_seen", lambda df, by, order: asked.append(tuple(by)) or plain(df, by, order))
    land_batch(store, frame(spark, doc("a"), doc("a", at=2), doc("b")))
    assert asked == [("beat_url",)]
    assert keys(store.incidents()) == ["a", "b"]
