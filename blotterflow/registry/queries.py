"""One query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotterflow.config import DEFAULT, PERIOD_TYPES
from blotterflow.functions import dates as D
from blotterflow.functions import rules as R
from blotterflow.functions import text as X
from blotterflow.operators import classify as C
from blotterflow.operators import dedup as K
from blotterflow.operators import normalize as N
from blotterflow.operators import quality as Q
from blotterflow.operators import segment as G
from blotterflow.plans import ingest as I
from blotterflow.plans import serving as V
from blotterflow.plans import warehouse as M
from blotterflow.registry import inputs as src
from blotterflow.session import shared_dir
from blotterflow.sources import html_pages as H
from blotterflow.sources import tables as TB
from blotterflow.sources.store import IncidentStore
from blotterflow.streaming.catchup import run_available

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

START, END = date(1996, 3, 1), date(1998, 6, 30)
SEMESTERS = ("Winter Semester 1996", "Fall Semester 1996", "Winter Semester 1997", "Fall Semester 1997")
ZONES = ("Academic Core", "Stadium / Athletics", "Helaman Halls", "Unknown")
CATEGORIES = ("Property", "Medical", "Traffic", "Uncategorized")
SEARCH = "alarm|lot #?[0-9]+"
#: What the first of two catch-up runs may classify; the second takes up the others.
CAP = 1000


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def strings(dates: str) -> F.Column:
    return F.array_join(F.col(dates).cast("array<string>"), ";")


# ---- text and dates -----------------------------------------------------------
@query
def text_whitespace(spark, sf):
    docs = src.costly(spark, sf, "documents", "doc_id", "text")
    return docs.select("doc_id", X.collapse_ws(F.col("text")).alias("clean"))


@query
def text_dash_fold(spark, sf):
    docs = src.order_documents(spark, sf)
    return docs.select("o_orderkey", X.fold_text(F.col("incident_text")).alias("folded"))


@query
def type_normalize(spark, sf):
    docs = src.order_documents(spark, sf)
    return docs.select(
        "o_orderkey",
        X.clean_type(F.col("incident_type")).alias("clean"),
        X.blank_to_null(F.col("incident_type")).alias("filled"),
        X.empty_to_null(F.col("beat_published_at")).alias("published"),
    )


@query
def title_range(spark, sf):
    docs = src.order_documents(spark, sf)
    bare = F.regexp_replace("beat_title", "[-]", " ")
    return docs.select(
        "o_orderkey",
        D.date_range(F.col("beat_title")).alias("range"),
        D.date_range(bare).alias("bare_range"),
    )


@query
def candidate_dates(spark, sf):
    docs = src.keyed_documents(spark, sf)
    return docs.select("o_orderkey", strings("incident_dates").alias("dates"))


@query
def multi_date_flag(spark, sf):
    docs = src.order_documents(spark, sf)
    return docs.select("o_orderkey", D.is_multi_date(D.date_range(F.col("beat_title"))).alias("multi"))


@query
def occurred_repair(spark, sf):
    docs = src.keyed_documents(spark, sf)
    first, last = F.array_min("incident_dates"), F.array_max("incident_dates")
    return docs.select("o_orderkey", D.occurred_date(first, last).alias("occurred"))


@query
def content_hash(spark, sf):
    docs = src.keyed_documents(spark, sf)
    digest = X.incident_hash(F.col("beat_url"), F.col("incident_type"), F.col("incident_text"))
    return docs.select("o_orderkey", digest.alias("digest"))


@query
def first_seen(spark, sf):
    docs = src.table(spark, sf, "documents")
    hashed = docs.select(F.sha2("text", 256).alias("digest"), "doc_id", "source")
    return K.first_seen(hashed, ["digest"], ["doc_id"])


@query
def csv_flat(spark, sf):
    """The flat snapshot, written and read back."""
    raw = src.raw_documents(spark, sf)
    path = src.written(spark, sf, "flat-csv", lambda folder: TB.write_raw_csv(raw, folder))
    return TB.read_csv(spark, path, I.flatten_for_csv(raw).schema)


# ---- lines to incidents ----------------------------------------------------------
def _lines(spark, sf):
    return G.with_clean_lines(src.report_texts(spark, sf), "text")


@query
def line_flags(spark, sf):
    lines = src.report_texts(spark, sf).select("key", F.posexplode(X.split_lines(F.col("text"))))
    line = F.col("line")
    return lines.select("key", F.col("pos").alias("line_no"), X.collapse_ws(F.col("col")).alias("line")).select(
        "key",
        "line_no",
        "line",
        X.has_marker(line).alias("is_marker"),
        X.is_noise_line(line).alias("is_noise"),
        X.is_title_or_date_line(line).alias("is_title"),
        X.is_plausible_incident_type(line).alias("is_type"),
        X.is_strict_heading_candidate(line).alias("is_heading"),
    )


@query
def clean_lines(spark, sf):
    lines = _lines(spark, sf)
    return lines.select("key", F.array_join("lines", "\n").alias("lines"))


@query
def blocks(spark, sf):
    found = _lines(spark, sf).select("key", G.nonempty_blocks(F.col("lines")).alias("blocks"))
    return G.unfold(found, "blocks", "block_no", "block").withColumn("block", F.array_join("block", "\n"))


def _incidents(df, column):
    return G.explode_incidents(df.select("key", column), column)


@query
def block_incidents(spark, sf):
    return _incidents(G.with_block_incidents(_lines(spark, sf)), "block")


@query
def flat_incidents(spark, sf):
    return _incidents(G.with_flat_incidents(_lines(spark, sf)), "flat")


@query
def pick_form(spark, sf):
    return _incidents(G.segment_lines(_lines(spark, sf)), "incidents")


# ---- pages -----------------------------------------------------------------------
@query
def page_lines(spark, sf):
    found = H.extract_containers(src.costly(spark, sf, "pages", "url", "html"))
    lines = G.with_clean_lines(found, "raw_text")
    kept = F.filter("lines", lambda x: x != "")
    return lines.select("url", "candidate_no", F.array_join(kept, "\n").alias("lines"))


@query
def page_incidents(spark, sf):
    return G.explode_incidents(I.page_incidents(src.costly(spark, sf, "pages", "url", "html")))


@query
def paragraph_fallback(spark, sf):
    found = H.extract_containers(src.costly(spark, sf, "pages", "url", "html"))
    texts = G.paragraph_incidents(F.col("flat_text"), F.col("paragraph_spans"))
    return found.select("url", F.posexplode(texts).alias("paragraph_no", "i")).select(
        "url", "paragraph_no", "i.incident_text"
    )


@query
def report_page_incidents(spark, sf):
    return G.explode_incidents(I.page_incidents(src.report_pages(spark, sf)))


@query
def report_pages_skipped(spark, sf):
    pages = src.report_pages(spark, sf)
    return G.skipped_pages(pages, I.page_incidents(pages))


@query
def list_items(spark, sf):
    return H.extract_list_items(src.list_pages(spark, sf))


@query
def report_summaries(spark, sf):
    return I.report_summaries(src.list_pages(spark, sf))


@query
def pages_to_documents(spark, sf):
    pages = src.report_pages(spark, sf)
    raw = I.raw_from_pages(src.list_pages(spark, sf), pages, F.timestamp_seconds(F.lit(0)))
    return raw.select("raw_text_hash", "beat_url", "incident_type", "incident_text", strings("incident_dates").alias("dates"))


# ---- classification ----------------------------------------------------------------
@query
def rule_match(spark, sf):
    docs = src.order_documents(spark, sf)
    text = docs.select("o_orderkey", X.fold_text(F.col("incident_text")).alias("text"))
    rules = DEFAULT.place_rules
    hit = text.withColumn("rule", R.first_rule(rules, F.col("text")))
    return hit.select(
        "o_orderkey",
        "rule",
        R.rule_value(rules, F.col("rule")).alias("zone"),
        R.rule_matched_text(rules, F.col("rule"), F.col("text")).alias("matched"),
    )


@query
def lot_lookup(spark, sf):
    docs = src.order_documents(spark, sf)
    number = docs.select("o_orderkey", R.lot_number(X.fold_text(F.col("incident_text"))).alias("lot"))
    return number.select("o_orderkey", "lot", R.lot_zone(F.col("lot")).alias("zone"))


@query
def deterministic(spark, sf):
    looked = C.with_lookup(src.order_documents(spark, sf), F.col("incident_text"))
    return looked.select("o_orderkey", "hit.zone", "hit.source", "hit.reasoning")


@query
def explicit_place(spark, sf):
    docs = src.order_documents(spark, sf)
    return docs.select("o_orderkey", R.names_place(X.fold_text(F.col("incident_text"))).alias("named"))


@query
def guarded(spark, sf):
    done = C.classify(src.order_documents(spark, sf), model=src.sample_model)
    return done.select("o_orderkey", "location.zone", "location.source", "location.reasoning")


@query
def confidence_tier(spark, sf):
    done = C.classify(src.order_documents(spark, sf), model=src.sample_model)
    return done.select("o_orderkey", R.confidence(F.col("location.source")).alias("confidence"))


@query
def source_counts(spark, sf):
    return C.source_counts(src.classified_documents(spark, sf))


def _half_classified(spark, sf):
    raw = src.raw_documents(spark, sf)
    done = F.substring("raw_text_hash", 1, 1) < "8"
    return raw.withColumn("location_zone", F.when(done, "MTC").otherwise(F.col("location_zone")))


@query
def pending_only(spark, sf):
    done = C.classify_pending(_half_classified(spark, sf))
    return done.select("raw_text_hash", "location_zone", "location_confidence", "location_source")


@query
def pending_limit(spark, sf):
    done = C.classify_pending(_half_classified(spark, sf), limit=100)
    return done.groupBy("location_zone").agg(F.count(F.lit(1)).alias("documents"))


# ---- normalization --------------------------------------------------------------------
@query
def norm_pending(spark, sf):
    raw = src.landed(spark, sf)
    return raw.filter(N.is_ready()).groupBy("beat_url").agg(F.count(F.lit(1)).alias("documents"))


@query
def norm_beats(spark, sf):
    return N.to_beats(src.raw_documents(spark, sf)).drop("scraped_at")


@query
def norm_incidents(spark, sf):
    return N.to_incidents(src.landed(spark, sf))


@query
def norm_dates(spark, sf):
    return N.to_dates(src.raw_documents(spark, sf))


@query
def norm_limit(spark, sf):
    """What is normalized after two capped runs."""
    raw = src.landed(spark, sf)
    for _ in range(2):
        raw = N.mark_normalized(raw, N.ready_documents(raw, 100))
    return raw.groupBy("raw_text_hash", "normalized").agg(F.count(F.lit(1)).alias("documents"))


@query
def norm_snapshot(spark, sf):
    """All tables after a run over what an earlier, partial run left."""
    raw = src.landed(spark, sf)
    done = raw.filter("normalized")
    seen = K.last_seen(done, ["raw_text_hash"], N.DOCUMENT_ORDER)
    beats = K.last_seen(N.to_beats(done), ["beat_url"], N.BEAT_ORDER)
    tables = {"beats": beats, "incidents": N.to_incidents(seen), "incident_dates": N.to_dates(seen)}
    after = N.normalize_pending(raw, tables)
    shown = {
        "beats": ("beat_url", "beat_title", "published_at", "date_range_raw"),
        "incidents": ("raw_text_hash", "location_zone", "earliest_date", "latest_date"),
        "incident_dates": ("raw_text_hash", "incident_date"),
        "raw_incidents": ("raw_text_hash", "normalized"),
    }
    found = None
    for name, (key, *columns) in shown.items():
        values = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
        rows = after[name].select(F.lit(name).alias("table_name"), F.col(key).alias("key"), F.concat_ws("|", *values).alias("row"))
        found = rows if found is None else found.unionByName(rows)
    return found.groupBy("table_name", "key", "row").agg(F.count(F.lit(1)).alias("rows"))


def _two_batches(spark, sf):
    """Overlapping batches that make up the table; the later one has changed titles, zones and dates."""
    docs = src.keyed_documents(spark, sf).withColumn("location_zone", F.lit("UNKNOWN"))
    docs = docs.withColumn("location_confidence", F.lit("NONE")).withColumn("location_source", F.lit("none"))
    old = docs.filter(F.col("o_orderkey") % 3 != 0)
    new = docs.filter((F.col("o_orderkey") % 2 == 0) | (F.col("o_orderkey") % 3 == 0))
    return old, new.withColumns(
        {
            "beat_title": F.concat("beat_title", F.lit(" (updated)")),
            "location_zone": F.lit("MTC"),
            "incident_dates": F.slice("incident_dates", 1, 1),
        }
    )


@query
def idempotent_insert(spark, sf):
    landed, incoming = _two_batches(spark, sf)
    fresh = K.new_rows(landed, incoming, "raw_text_hash", ["o_orderkey"])
    return fresh.select("raw_text_hash", "o_orderkey", "beat_url")


@query
def insert_counts(spark, sf):
    landed, incoming = _two_batches(spark, sf)
    return K.insert_counts(landed, incoming, "raw_text_hash")


@query
def upsert_beats(spark, sf):
    old, new = (N.to_beats(batch) for batch in _two_batches(spark, sf))
    existing = K.last_seen(old, ["beat_url"], N.BEAT_ORDER)
    return K.upsert(existing, new, "beat_url", N.BEAT_ORDER).drop("scraped_at")


@query
def upsert_incidents(spark, sf):
    old, new = (K.last_seen(b, ["raw_text_hash"], N.DOCUMENT_ORDER) for b in _two_batches(spark, sf))
    return K.upsert(N.to_incidents(old), N.to_incidents(new), "raw_text_hash", ["beat_url"])


@query
def replace_dates(spark, sf):
    old, new = (K.last_seen(b, ["raw_text_hash"], N.DOCUMENT_ORDER) for b in _two_batches(spark, sf))
    return K.replace_children(N.to_dates(old), N.to_dates(new), new, "raw_text_hash")


@query
def mark_normalized(spark, sf):
    raw = src.keyed_documents(spark, sf).withColumn("normalized", F.lit(False))
    written = raw.filter(F.col("o_orderkey") % 2 == 0)
    return N.mark_normalized(raw, written).select("o_orderkey", "normalized")


# ---- star schema -----------------------------------------------------------------------
@query
def stg_beats(spark, sf):
    return M.stg_beats(src.clean_tables(spark, sf)["beats"]).drop("scraped_at")


@query
def stg_incidents(spark, sf):
    return src.staged_incidents(spark, sf)


@query
def stg_incident_dates(spark, sf):
    return M.stg_incident_dates(src.clean_tables(spark, sf)["incident_dates"])


@query
def date_bounds(spark, sf):
    return M.date_bounds(src.staged_incidents(spark, sf))


@query
def dim_date(spark, sf):
    return M.dim_date(src.staged_incidents(spark, sf), src.calendar(spark))


@query
def dim_location(spark, sf):
    return M.dim_location(src.staged_incidents(spark, sf))


@query
def dim_incident_type(spark, sf):
    return M.dim_incident_type(src.staged_incidents(spark, sf))


@query
def fct_incidents(spark, sf):
    return M.fct_incidents(src.staged_incidents(spark, sf))


@query
def daily_summary(spark, sf):
    staged = src.staged_incidents(spark, sf)
    return M.daily_summary(M.dim_date(staged, src.calendar(spark)), M.fct_incidents(staged))


# ---- data quality ------------------------------------------------------------------------
@query
def check_unique(spark, sf):
    orders = src.table(spark, sf, "orders")
    return Q.duplicate_keys(orders, "o_custkey")


@query
def check_not_null(spark, sf):
    docs = src.order_documents(spark, sf).withColumn("kind", X.blank_to_null(F.col("incident_type")))
    return Q.null_rows(docs, "kind").select("o_orderkey")


@query
def check_accepted(spark, sf):
    customers = src.table(spark, sf, "customer")
    return Q.unaccepted_values(customers, "c_mktsegment", ["BUILDING", "MACHINERY"])


@query
def check_relationship(spark, sf):
    stray = F.when(F.col("o_orderkey") % 7 == 0, -1 - F.col("o_custkey")).otherwise(F.col("o_custkey"))
    orders = src.table(spark, sf, "orders").withColumn("o_custkey", stray)
    return Q.orphans(orders, "o_custkey", src.table(spark, sf, "customer"), "c_custkey")


@query
def check_suite(spark, sf):
    return Q.run_suite(M.model_checks(src.checked_tables(spark, sf)))


@query
def check_suite_failures(spark, sf):
    orders, customers = src.table(spark, sf, "orders"), src.table(spark, sf, "customer")
    nations = src.table(spark, sf, "nation")
    stray = F.when(F.col("c_custkey") % 7 == 0, -1 - F.col("c_nationkey")).otherwise(F.col("c_nationkey"))
    strays = customers.withColumn("c_nationkey", stray)
    return Q.run_suite(
        [
            Q.unique(orders, "orders", "o_orderkey"),
            Q.unique(orders, "orders", "o_custkey"),
            Q.not_null(orders, "orders", "o_orderdate"),
            Q.accepted_values(orders, "orders", "o_orderstatus", ["F", "O"]),
            Q.accepted_values(customers, "customer", "c_mktsegment", PERIOD_TYPES),
            Q.relationship(customers, "customer", "c_nationkey", nations, "n_nationkey"),
            Q.relationship(strays, "strays", "c_nationkey", nations, "n_nationkey"),
        ]
    )


# ---- reports -------------------------------------------------------------------------------
def _detail(spark, sf, *columns):
    return src.usual_detail(spark, sf, columns or V.DETAIL_COLUMNS)


def _spine(spark, sf):
    return src.usual_spine(spark, sf)


def _filtered(spark, sf, *columns, search=""):
    # the filtered columns are always needed
    needed = {"date", "semester", "zone", "category", *columns} if columns else ()
    return V.filter_incidents(
        _detail(spark, sf, *needed), START, END, SEMESTERS, ZONES, CATEGORIES, search
    )


def _filtered_spine(spark, sf):
    return V.filter_spine(_spine(spark, sf), START, END, SEMESTERS)


@query
def incident_detail(spark, sf):
    return V.newest_first(V.incident_detail(src.star(spark, sf), (*V.DETAIL_COLUMNS, V.ROW_ID)))


@query
def spine(spark, sf):
    """The spine of the catalog's summary, which is built if the marts aren't there."""
    return V.date_spine(spark.table(f"{src.catalog(spark, sf)}.mart_daily_summary"))


@query
def outlier_days(spark, sf):
    return src.outlier_days(spark, sf)


@query
def outliers_excluded(spark, sf):
    return _detail(spark, sf, "date", "zone", "category", "type", "narrative")


@query
def spine_filtered(spark, sf):
    return _filtered_spine(spark, sf)


@query
def filtered(spark, sf):
    return _filtered(spark, sf)


@query
def search(spark, sf):
    return V.filter_incidents(_detail(spark, sf), search=SEARCH)


@query
def search_literal(spark, sf):
    return V.filter_incidents(_detail(spark, sf), search="LOT #41.", literal=True)


@query
def headline(spark, sf):
    return V.headline(_filtered(spark, sf, "zone", "zone_unknown"), _filtered_spine(spark, sf))


@query
def daily_trend(spark, sf):
    return V.daily_trend(_filtered(spark, sf, "date"), _filtered_spine(spark, sf))


@query
def daily_trend_all(spark, sf):
    return V.daily_trend(_detail(spark, sf, "date"), _spine(spark, sf))


@query
def calendar_effect(spark, sf):
    return V.calendar_effect(_detail(spark, sf, "date"), _spine(spark, sf))


@query
def by_zone(spark, sf):
    return V.by_zone(_detail(spark, sf, "date", "zone", "zone_unknown"))


@query
def by_category(spark, sf):
    return V.by_category(_detail(spark, sf, "date", "category"))


@query
def zone_category_grid(spark, sf):
    return V.zone_category_grid(_detail(spark, sf, "date", "zone", "zone_unknown", "category"))


@query
def weekday_profile(spark, sf):
    return V.weekday_profile(_detail(spark, sf, "date"))


@query
def filter_options(spark, sf):
    return V.filter_options(_detail(spark, sf, "date", "semester", "zone", "category"))


@query
def spine_bounds(spark, sf):
    return V.spine_bounds(_spine(spark, sf))


@query
def explorer(spark, sf):
    """The explorer's table, exported and read back."""
    table = V.explorer(_filtered(spark, sf, "type", "narrative", V.ROW_ID, search=SEARCH))
    path = src.written(spark, sf, "explorer-csv", lambda folder: TB.write_explorer_csv(table, folder))
    return TB.read_csv(spark, path, table.schema)


@query
def explorer_counts(spark, sf):
    found = _filtered(spark, sf, "narrative", search=SEARCH)
    return V.match_counts(found, _detail(spark, sf, "date"))


# ---- incremental -----------------------------------------------------------------------------
_runs = iter(range(1 << 30))


@query
def incremental_run(spark, sf):
    """Two landing drops that overlap, each followed by a catch-up run; the first is capped."""
    root = f"{shared_dir(spark)}/run-{spark.sparkContext.applicationId}-{next(_runs)}"
    store = IncidentStore(spark, f"{root}/store")
    docs = src.keyed_documents(spark, sf)
    key = F.col("o_orderkey")
    for drop, limit in ((key % 3 != 0, CAP), ((key % 2 != 0) | (key % 3 == 0), None)):
        rows = docs.filter(drop).drop("raw_text_hash", "o_orderkey")
        I.as_raw_document(rows).write.mode("append").parquet(f"{root}/landing")
        run_available(spark, f"{root}/landing", store, f"{root}/checkpoint", limit=limit)
    return store.incidents()
