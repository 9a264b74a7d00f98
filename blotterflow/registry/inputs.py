"""The given tables, and the projections the queries share."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence
from dataclasses import replace

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterflow.config import DEFAULT
from blotterflow.functions.text import incident_hash
from blotterflow.operators.classify import classify_pending
from blotterflow.operators.dedup import last_seen, last_seen_stored
from blotterflow.operators.normalize import (
    BEAT_ORDER,
    DOCUMENT_ORDER,
    to_beats,
    to_dates,
    to_incidents,
)
from blotterflow.plans import serving as V
from blotterflow.plans import warehouse as M
from blotterflow.plans.build import build_marts
from blotterflow.plans.ingest import as_raw_document, with_title_dates
from blotterflow.registry import samples
from blotterflow.schemas import RAW_INCIDENTS
from blotterflow.session import shared_dir
from blotterflow.sources.tables import (
    MARTS,
    STORE_TABLES,
    marts_exist,
    read_calendar,
    read_tables,
    save_marts,
    write_csv,
)

# the years the given orders fall in
FIRST_YEAR, LAST_YEAR = 1995, 2001
# more orders make more sites, not more years: a site has so many, and so many on a day
ORDERS_PER_SITE, ORDERS_PER_DAY = 15_000, 6.237
# what one task of costly per-row work takes
ROWS_PER_TASK = 50_000
# a day is an outlier that exceeds the usual number by so many times its square root
OUTLIER_SPREAD = 2.4


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def costly(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for per-row work that is worth all cores.

    Splits go by bytes, and rows of few bytes may take long: tables whose splits hold more
    than ``ROWS_PER_TASK`` rows, or don't fill the cores, are dealt out. Others are not shuffled.
    """
    rows, cores = table(spark, sf, name).select(*columns), spark.sparkContext.defaultParallelism
    wanted = max(cores, math.ceil(table(spark, sf, name).count() / ROWS_PER_TASK))
    return rows if rows.rdd.getNumPartitions() >= wanted else rows.repartition(wanted)


def _pick(values, position: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def _slash(day: Column) -> Column:
    return F.date_format(day, "MM/dd/yyyy")


def order_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as scraped documents, before dates and hash are worked out."""
    orders = costly(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return documents_of(orders.withColumn("day", F.to_date("o_orderdate")))


def documents_of(orders: DataFrame) -> DataFrame:
    site = F.expr(f"(o_orderkey - 1) div {ORDERS_PER_SITE}").cast("string")
    day, key = F.col("day"), F.col("o_orderkey")
    title = F.concat(
        F.lit("Police Beat - "),
        _slash(day),
        F.when(F.day(day) % 5 == 0, F.concat(F.lit(" - "), _slash(F.date_add(day, 2)))).otherwise(""),
        F.when(
            F.dayofyear(day) % 97 == 0, F.concat(F.lit(" - "), _slash(F.add_months(day, -240)))
        ).otherwise(""),
    )
    note = F.when(key % 5 != 0, F.concat(F.lit(" Case "), key.cast("string"), F.lit("."))).otherwise("")
    return orders.select(
        key.alias("o_orderkey"),
        F.concat(F.lit("https://beat.example/"), site, F.lit("/"), F.date_format(day, "yyyy-MM-dd")).alias("beat_url"),
        title.alias("beat_title"),
        F.when(F.col("o_custkey") % 7 == 0, "")
        .otherwise(F.date_format(F.date_add(day, 1), "yyyy-MM-dd"))
        .alias("beat_published_at"),
        _pick(samples.TYPES, F.col("o_custkey") % len(samples.TYPES)).alias("incident_type"),
        F.concat(_pick(samples.TEXTS, key % len(samples.TEXTS)), note).alias("incident_text"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 1 DAY")).alias("scraped_at"),
    )


def raw_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as raw landing documents."""
    return as_raw_document(with_title_dates(order_documents(spark, sf), "beat_title"))


def keyed_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Raw documents plus the order key, for splitting into batches."""
    docs = with_title_dates(order_documents(spark, sf), "beat_title")
    hashed = incident_hash(F.col("beat_url"), F.col("incident_type"), F.col("incident_text"))
    return docs.withColumn("raw_text_hash", hashed)


def classified_documents(spark: SparkSession, sf: str) -> DataFrame:
    return classify_pending(raw_documents(spark, sf))


_written: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf: str, name: str, build) -> str:
    """The folder of a derived table, which ``build(folder)`` writes once per application."""
    app = spark.sparkContext.applicationId
    if (app, sf, name) not in _written:
        place = hashlib.sha256(sf.encode()).hexdigest()[:16]
        folder = f"{shared_dir(spark)}/{name}-{app}-{place}"
        build(folder)
        _written[app, sf, name] = folder
    return _written[app, sf, name]


def landed(spark: SparkSession, sf: str) -> DataFrame:
    """All documents as landed and classified, the multi-date ones normalized.

    Classification is the costly step, and it is stored with the documents:
    whatever reads them afterwards does not repeat it.
    """
    done = F.col("is_multi_date_beat")

    def build(folder: str) -> None:
        docs = classified_documents(spark, sf).withColumn("normalized", done)
        docs.write.mode("overwrite").parquet(folder)

    return spark.read.schema(RAW_INCIDENTS).parquet(written(spark, sf, "landed", build))


def clean_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Beats, incidents and dates of all landed documents, as written tables."""

    def build(folder: str) -> None:
        documents = landed(spark, sf)
        docs = last_seen_stored(documents, ["raw_text_hash"], DOCUMENT_ORDER, f"{folder}/recurring")
        beats = last_seen(to_beats(documents), ["beat_url"], BEAT_ORDER)
        beats.write.mode("overwrite").parquet(f"{folder}/beats")
        to_incidents(docs).write.mode("overwrite").parquet(f"{folder}/incidents")
        to_dates(docs).write.mode("overwrite").parquet(f"{folder}/incident_dates")

    return read_tables(spark, written(spark, sf, "clean", build), STORE_TABLES)


def staged_incidents(spark: SparkSession, sf: str) -> DataFrame:
    return M.stg_incidents(clean_tables(spark, sf)["incidents"])


def calendar(spark: SparkSession) -> DataFrame:
    """The calendar of the orders' years, as a seed file that is read back."""
    path = written(spark, "", "calendar", lambda folder: write_csv(calendar_rows(spark), folder))
    return read_calendar(spark, path)


def calendar_rows(spark: SparkSession) -> DataFrame:
    """A calendar for the years of the orders, by rule.

    Four semesters a year; finals are a semester's last five days; breaks are
    the gaps; game days are two fixed dates.
    """
    terms = (
        ("Winter Semester", 1, 8, 4, 22),
        ("Spring Term", 4, 29, 6, 18),
        ("Summer Term", 6, 24, 8, 13),
        ("Fall Semester", 9, 3, 12, 17),
    )
    rows = []
    for year in range(FIRST_YEAR, LAST_YEAR + 1):
        for i, (label, m1, d1, m2, d2) in enumerate(terms):
            start, end = f"{year}-{m1:02}-{d1:02}", f"{year}-{m2:02}-{d2:02}"
            nxt = terms[(i + 1) % 4]
            nxt_start = f"{year + (i == 3)}-{nxt[1]:02}-{nxt[2]:02}"
            rows.append(("SEMESTER", f"{label} {year}", start, end))
            rows.append(("FINALS", f"{label} {year} Finals", _shift(end, -4), end))
            rows.append(("BREAK", f"Break after {label} {year}", _shift(end, 1), _shift(nxt_start, -1)))
        for month, day in ((9, 12), (10, 17)):
            game = f"{year}-{month:02}-{day:02}"
            rows.append(("GAME_DAY", f"Home game {game}", game, game))
    frame = spark.createDataFrame(rows, "period_type string, label string, start_date string, end_date string")
    return frame.withColumns({c: F.col(c).cast("date") for c in ("start_date", "end_date")})


def _shift(day: str, days: int) -> str:
    return (pd.Timestamp(day) + pd.Timedelta(days=days)).strftime("%Y-%m-%d")


def star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The marts as written tables.

    Report queries read the built marts, as a dashboard does, instead of
    building the star again for each chart.
    """

    def build(folder: str) -> None:
        build_marts(spark, staged_incidents(spark, sf), calendar(spark), folder)

    return read_tables(spark, written(spark, sf, "star", build), MARTS)


def catalog(spark: SparkSession, sf: str) -> str:
    """The catalog database of the marts of ``sf``; they are saved where they don't exist yet."""
    place = hashlib.sha256(f"{spark.sparkContext.applicationId} {sf}".encode()).hexdigest()[:16]
    database = f"marts_{place}"
    if not marts_exist(spark, database):
        save_marts(star(spark, sf), database, f"{shared_dir(spark)}/{database}")
    return database


def checked_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Everything the declared checks look at."""
    store = clean_tables(spark, sf)
    return {**store, **M.staging(store), **star(spark, sf), "academic_calendar": calendar(spark)}


def outlier_threshold(spark: SparkSession, sf: str) -> int:
    """What a day of all sites together may have; it grows with their number."""
    last = table(spark, sf, "orders").agg(F.max("o_orderkey").alias("key")).first().key or 1
    usual = ORDERS_PER_DAY * ((last - 1) // ORDERS_PER_SITE + 1)
    return math.floor(usual + OUTLIER_SPREAD * math.sqrt(usual))


def outlier_days(spark: SparkSession, sf: str) -> DataFrame:
    return V.outlier_days(star(spark, sf)["mart_daily_summary"], replace(DEFAULT, outlier_day_threshold=outlier_threshold(spark, sf)))


def usual_detail(
    spark: SparkSession, sf: str, columns: Sequence[str] = V.DETAIL_COLUMNS
) -> DataFrame:
    """V3: incident detail without outlier days."""
    detail = V.incident_detail(star(spark, sf), columns)
    return V.exclude_days(detail, outlier_days(spark, sf), "date")


def usual_spine(spark: SparkSession, sf: str) -> DataFrame:
    """V3: the spine without outlier days."""
    spine = star(spark, sf)["mart_daily_summary"].select("date_day", "semester", *V.FLAGS)
    return V.exclude_days(spine, outlier_days(spark, sf), "date_day")


def report_texts(spark: SparkSession, sf: str) -> DataFrame:
    """All documents, and one report per order, as ``key`` and whole ``text``."""
    docs = costly(spark, sf, "documents", "doc_id", "text").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"), "text"
    )
    o = order_documents(spark, sf)
    form = _pick(samples.REPORTS, F.col("o_orderkey") % len(samples.REPORTS))
    filled = fill(form, F.col("incident_type"), F.col("incident_text"), F.substring("beat_title", 15, 10))
    reports = o.select(F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("key"), filled.alias("text"))
    return docs.unionByName(reports)


def fill(form: Column, kind: Column, text: Column, day: Column) -> Column:
    return F.replace(
        F.replace(F.replace(form, F.lit("{type}"), kind), F.lit("{text}"), text), F.lit("{day}"), day
    )


def report_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One HTML report page per order, as ``url`` and ``html``."""
    o = order_documents(spark, sf)
    form = _pick(samples.PAGES, F.col("o_orderkey") % len(samples.PAGES))
    html = fill(form, F.col("incident_type"), F.col("incident_text"), F.substring("beat_title", 15, 10))
    url = F.concat(F.lit("https://beat.example/report/"), F.col("o_orderkey").cast("string"))
    return o.select(url.alias("url"), html.alias("html"), "o_orderkey", "beat_title", "beat_published_at")


def list_pages(spark: SparkSession, sf: str) -> DataFrame:
    """One HTML list page per order: its report, a repeated one, and strangers."""
    o = order_documents(spark, sf)
    key = F.col("o_orderkey")

    def item(url: Column, text: Column) -> Column:
        return F.concat(
            F.lit("<div class='ListImageSmall-items-item'><h3 class='PromoImageSmall-title'><a href='"),
            url,
            F.lit("'>"),
            text,
            F.lit("</a></h3><div class='PromoImageSmall-nameAndDate'><i class='date'> "),
            F.col("beat_published_at"),
            F.lit(" </i></div></div>"),
        )

    html = F.concat(
        F.lit("<html><body>"),
        item(F.concat(F.lit("/report/"), key.cast("string")), F.col("beat_title")),
        item(F.lit("/other"), F.lit("Campus  news")),
        item(
            F.concat(F.lit("report/"), F.greatest(key - 1, F.lit(0)).cast("string")),
            F.lit("POLICE&nbsp;Beat 01/02/1996 01/03/1996"),
        ),
        F.lit("<a href='?page="),
        (key + 1).cast("string"),
        F.lit("'>Go to <b>next</b> page</a></body></html>"),
    )
    return o.select(key.alias("page_no"), F.lit("https://beat.example/").alias("url"), html.alias("html"))


def sample_model(texts: pd.Series) -> pd.Series:
    """A deterministic stand-in for a model: the text's length picks a zone."""
    answers = [f" {zone.lower()} " for zone in DEFAULT.zones] + ["north_quad"]
    return texts.str.len().map(lambda n: answers[n % len(answers)])
