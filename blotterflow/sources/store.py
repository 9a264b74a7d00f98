"""Landing table and clean store as append-only batches.

Every batch writes its own ``batch_id=N`` folder in each table and then one
row in ``commits``; readers take committed batches only. A run that dies half
way leaves nothing visible, and the next batch replaces its folders. The cost
of a write follows the batch, not the store: earlier rows are never rewritten.
Where keys recur, the last committed batch wins when the store is read, which
is the upsert of N5-N7. A store has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotterflow import schemas as S
from blotterflow.operators.caps import nth_key
from blotterflow.operators.classify import Model, ask, source_counts
from blotterflow.operators.dedup import last_seen
from blotterflow.operators.normalize import (
    BEAT_ORDER,
    DOCUMENT_ORDER,
    to_beats,
    to_dates,
    to_incidents,
)
from blotterflow.sources.landed_keys import with_prefixes, write_keys

COMMITS = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("skipped", T.LongType()),
        T.StructField("rejected", T.LongType()),
        # Incidents per deciding layer
        T.StructField("sources", T.MapType(T.StringType(), T.LongType())),
        # The backlog is done up to this key of this batch, or all of it; and what is left
        T.StructField("done_batch", T.LongType()),
        T.StructField("done_key", T.StringType()),
        T.StructField("waiting", T.LongType()),
    ]
)
# the batch that landed a document, which isn't the one that classified it after a capped run
LANDED_IN = T.StructField("landed_in", T.LongType())
KEY = "raw_text_hash"
# What the model said; it belongs to no batch, so that a batch that dies need not ask again
ANSWERS = T.StructType([T.StructField("text", T.StringType()), T.StructField("proposed", T.StringType())])
TABLES = {
    **{n: T.StructType([*S.TABLES[n].fields, LANDED_IN]) for n in ("raw_incidents", "beats")},
    **{n: S.TABLES[n] for n in ("incidents", "incident_dates")},
    "backlog": S.RAW_INCIDENTS,
    "landed_keys": T.StructType([T.StructField(KEY, T.StringType()), T.StructField("prefix", T.IntegerType())]),
    "commits": COMMITS,
}


class IncidentStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        for name in TABLES:
            # batch -1 holds no rows; it makes every table readable from the start
            place = "-1/prefix=0" if name == "landed_keys" else "-1"
            self._write(spark.createDataFrame([], TABLES[name]), name, place, mode="ignore")
        spark.createDataFrame([], ANSWERS).write.mode("ignore").parquet(self._path("answers"))

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _write(self, df: DataFrame, name: str, batch_id: int | str, mode: str = "overwrite") -> None:
        columns = [c for c in TABLES[name].fieldNames() if c not in ("batch_id", "prefix")]
        df.select(*columns).write.mode(mode).parquet(f"{self._path(name)}/batch_id={batch_id}")

    def _all(self, name: str) -> DataFrame:
        fields = [f for f in TABLES[name].fields if f.name != "batch_id"]
        schema = T.StructType([*fields, T.StructField("batch_id", T.LongType())])
        return self.spark.read.schema(schema).parquet(self._path(name))

    def commits(self) -> DataFrame:
        return self._all("commits")

    def next_batch_id(self) -> int:
        """One above the last commit, whatever stream or checkpoint it came from."""
        last = self.commits().agg(F.max("batch_id")).first()[0]
        return 0 if last is None else last + 1

    def last_commit(self) -> Row | None:
        return self.commits().orderBy(F.desc("batch_id")).first()

    def committed(self, name: str) -> DataFrame:
        """All committed rows of a table with their batch.

        Batches are named by the runs of their numbers, of which there is one unless
        folders were taken away.
        """
        runs: list[list[int]] = []
        for n in sorted(r.batch_id for r in self.commits().select("batch_id").collect()):
            if runs and n == runs[-1][1] + 1:
                runs[-1][1] = n
            else:
                runs.append([n, n])
        named = [F.col("batch_id").between(low, high) for low, high in runs]
        return self._all(name).where(reduce(lambda a, b: a | b, named, F.lit(False)))

    def landed_keys(self, prefixes: Sequence[int]) -> DataFrame:
        """The keys of all documents ever landed that have one of these prefixes."""
        return with_prefixes(self.committed("landed_keys"), prefixes).select(KEY)

    # ---- current state ------------------------------------------------------
    def raw_incidents(self) -> DataFrame:
        """Every landed document; those that wait have no zone yet."""
        done = self.committed("raw_incidents").drop("batch_id", "landed_in")
        return done.unionByName(self.waiting().drop("landed_in"))

    def waiting(self, arriving: int | None = None) -> DataFrame:
        """What capped runs have landed and not classified, with the batch that landed it.

        ``arriving`` is a batch to be counted in although it isn't committed yet.
        """
        last, rows = self.last_commit(), self.committed("backlog")
        if arriving is not None:
            rows = rows.unionByName(self._all("backlog").where(F.col("batch_id") == arriving))
        if last is not None:
            here, after = F.col("batch_id") == last.done_batch, F.col("batch_id") > last.done_batch
            rows = rows.where(after if last.done_key is None else here & (F.col(KEY) > last.done_key) | after)
        return rows.withColumnRenamed("batch_id", "landed_in")

    def _current_incidents(self, columns: Sequence[str]) -> DataFrame:
        rows = self.committed("incidents").select(KEY, *columns, "batch_id")
        return last_seen(rows, [KEY], ["batch_id"])

    def incidents(self, *columns: str) -> DataFrame:
        """One row per hash, from the last batch that wrote it.

        With ``columns`` only these are read and shuffled, next to the hash.
        """
        names = columns or [c for c in S.INCIDENTS.fieldNames() if c != "raw_text_hash"]
        return self._current_incidents(names).drop("batch_id")

    def beats(self) -> DataFrame:
        """One row per page, from the batch that landed it last."""
        rows = self.committed("beats").drop("batch_id")
        return last_seen(rows, ["beat_url"], ["landed_in", *BEAT_ORDER]).drop("landed_in")

    def incident_dates(self) -> DataFrame:
        """The dates written together with each incident's current row."""
        current = self._current_incidents(())
        dates = self.committed("incident_dates")
        return dates.join(current, ["raw_text_hash", "batch_id"], "left_semi").drop("batch_id")

    def tables(self) -> dict[str, DataFrame]:
        return {
            "beats": self.beats(),
            "incidents": self.incidents(),
            "incident_dates": self.incident_dates(),
        }

    # ---- writing ------------------------------------------------------------
    def answers(self) -> DataFrame:
        """Every text the model has been asked, with one answer."""
        return self.spark.read.schema(ANSWERS).parquet(self._path("answers")).dropDuplicates(["text"])

    def ask(self, texts: DataFrame, model: Model) -> DataFrame:
        """The answers to ``texts(text)``, from the model only where it hasn't been asked yet.

        Answers are kept for good: a store goes with one model.
        """
        new = texts.join(self.answers(), "text", "left_anti")
        ask(new, model).write.mode("append").parquet(self._path("answers"))
        return texts.join(self.answers(), "text")

    def take(self, fresh: DataFrame, limit: int | None) -> tuple[DataFrame, tuple]:
        """The documents to classify now, and how far the backlog is done with them.

        Without a limit these are the backlog and ``fresh``. With one, ``fresh`` is written to the
        backlog first, and the first ``limit`` documents of it are taken: batch by batch, by key.
        """
        batch_id, last = self.next_batch_id(), self.last_commit()
        if limit is None:
            mine = fresh.withColumn("landed_in", F.lit(batch_id).cast("long"))
            left = 0 if last is None else last.waiting
            return (mine if not left else self.waiting().unionByName(mine)), (batch_id, None, 0)
        self._write(fresh, "backlog", batch_id)
        rows = self.waiting(batch_id)
        counts = sorted((r.landed_in, r["count"]) for r in rows.groupBy("landed_in").count().collect())
        total = sum(n for _, n in counts)
        if limit <= 0:
            done = (-1, None) if last is None else (last.done_batch, last.done_key)
            return rows.where(F.lit(False)), (*done, total)
        room = limit
        for landed_in, n in counts:
            if room <= n:
                here, before = F.col("landed_in") == landed_in, F.col("landed_in") < landed_in
                key = None if room == n else nth_key(rows.where(here), KEY, room)
                return rows.where(before | (here if key is None else here & (F.col(KEY) <= key))), (landed_in, key, total - limit)
            room -= n
        return rows, (batch_id, None, 0)

    def write_batch(
        self, classified: DataFrame, received: int | None = None, rejected: int = 0, progress: tuple | None = None,
        one_a_key: bool = False,
    ) -> int:
        """Land classified documents and their clean rows as one unit.

        The landed table is read back for the clean rows, so rules and model
        run once however often a later write is retried. N8's flag is raised in
        the landed rows: they become visible together with the clean rows. ``progress`` is what
        ``take`` gave with the documents. With ``one_a_key`` no key comes twice, and rows are not grouped by it again.
        """
        batch_id, last = self.next_batch_id(), self.last_commit()
        single = classified if one_a_key else last_seen(classified, [KEY], DOCUMENT_ORDER)
        documents = single.withColumn("normalized", F.lit(True))
        if "landed_in" not in documents.columns:
            documents = documents.withColumn("landed_in", F.lit(batch_id).cast("long"))
        if progress is None:
            progress = (-1, None, 0) if last is None else (last.done_batch, last.done_key, last.waiting)
        self._write(documents, "raw_incidents", batch_id)
        landed = self._all("raw_incidents").filter(F.col("batch_id") == batch_id)
        beats = last_seen(to_beats(landed, "landed_in"), ["beat_url"], ["landed_in", *BEAT_ORDER])
        self._write(beats, "beats", batch_id)
        self._write(to_incidents(landed), "incidents", batch_id)
        self._write(to_dates(landed), "incident_dates", batch_id)
        # a capped run has all its documents in the backlog, also those it has classified
        arrived = landed.where(F.col("landed_in") == batch_id).select(KEY)
        arrived = arrived.union(self._all("backlog").where(F.col("batch_id") == batch_id).select(KEY)).distinct()
        write_keys(arrived, KEY, f"{self._path('landed_keys')}/batch_id={batch_id}")
        sources = {r.location_source: r.incidents for r in source_counts(landed).collect()}  # a row for each layer
        inserted = self._all("landed_keys").where(F.col("batch_id") == batch_id).count()
        skipped = (inserted + rejected if received is None else received) - inserted - rejected
        self._commit(batch_id, inserted, skipped, rejected, {k: n for k, n in sources.items() if k}, progress)
        return batch_id

    def _commit(
        self, batch_id: int, inserted: int, skipped: int, rejected: int = 0, sources: dict | None = None, progress: tuple = (-1, None, 0)
    ) -> None:
        row = self.spark.createDataFrame([(batch_id, inserted, skipped, rejected, sources, *progress)], COMMITS)
        self._write(row, "commits", batch_id)

    def compact_to(self, root: str) -> IncidentStore:
        """The current state as one batch of a new store, without past versions."""
        target = IncidentStore(self.spark, root)
        batch_id = target.next_batch_id()
        here = F.lit(batch_id).cast("long").alias("landed_in")
        done = self.committed("raw_incidents").drop("batch_id")
        target._write(done.drop("landed_in").select("*", here), "raw_incidents", batch_id)
        for name, df in self.tables().items():
            target._write(df.select("*", here) if name == "beats" else df, name, batch_id)
        waiting = self.waiting().drop("landed_in")
        target._write(waiting, "backlog", batch_id)
        write_keys(self.committed("landed_keys"), KEY, f"{target._path('landed_keys')}/batch_id={batch_id}")
        self.answers().write.mode("append").parquet(target._path("answers"))
        left = target._all("backlog").where(F.col("batch_id") == batch_id).count()
        target._commit(batch_id, target._all("incidents").count(), 0, progress=(-1, None, left))
        return target
