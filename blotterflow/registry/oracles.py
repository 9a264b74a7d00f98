"""DuckDB SQL for each query, written apart from the Spark operators.

Each statement starts from the given tables. Fixed values (rules, word lists,
sample texts) are shared; how they are applied is spelled out again in SQL.
"""

from __future__ import annotations

from blotterflow import config as C
from blotterflow.registry import samples

ORACLES: dict[str, str] = {}


def lit(value: str) -> str:
    return "'" + value.replace("'", "''").replace("\n", "' || chr(10) || '").replace("\t", "' || chr(9) || '") + "'"


def items(values) -> str:
    return "[" + ", ".join(lit(v) for v in values) + "]"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


# RE2's \s is ASCII, so the whitespace class is written out
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"
DATE = "[0-9]{2}/[0-9]{2}/[0-9]{4}"
TITLE = r"(?i)police\s+beat\s*(?:•|[-:])\s*(.+)$"


def ws(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS}', ' ', 'g'))"


def clean_type(c: str) -> str:
    return f"regexp_replace({ws(c)}, ':+$', '')"


def fold(c: str) -> str:
    return ws(f"translate({c}, '‐‑‒–—―−', '-------')")


def range_of(title: str) -> str:
    return (
        f"CASE WHEN regexp_matches({title}, '{TITLE}') THEN {ws(f'regexp_extract({title}, {lit(TITLE)}, 1)')} "
        f"ELSE array_to_string(regexp_extract_all({title}, '{DATE}'), ' - ') END"
    )


# ---- orders as documents -----------------------------------------------------
DOCS = rf"""
docs0 AS (
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, o_orderdate,
         ({items(samples.TYPES)})[o_custkey % {len(samples.TYPES)} + 1] AS incident_type,
         ({items(samples.TEXTS)})[o_orderkey % {len(samples.TEXTS)} + 1]
           || CASE WHEN o_orderkey % 5 <> 0 THEN ' Case ' || o_orderkey || '.' ELSE '' END AS incident_text
  FROM orders),
docs1 AS (
  SELECT *, 'https://beat.example/' || ((o_orderkey - 1) // 15000) || '/' || strftime(day, '%Y-%m-%d') AS beat_url,
         'Police Beat - ' || strftime(day, '%m/%d/%Y')
           || CASE WHEN date_part('day', day) % 5 = 0 THEN ' - ' || strftime(day + 2, '%m/%d/%Y') ELSE '' END
           || CASE WHEN dayofyear(day) % 97 = 0 THEN ' - ' || strftime(day - INTERVAL 20 YEAR, '%m/%d/%Y') ELSE '' END
           AS beat_title,
         CASE WHEN o_custkey % 7 = 0 THEN '' ELSE strftime(day + 1, '%Y-%m-%d') END AS beat_published_at,
         o_orderdate + INTERVAL 1 DAY AS scraped_at
  FROM docs0),
docs2 AS (SELECT *, {range_of('beat_title')} AS date_range_raw FROM docs1),
docs3 AS (
  SELECT *, list_filter(list_transform(regexp_extract_all(date_range_raw, '{DATE}'),
              lambda x: CAST(try_strptime(x, '%m/%d/%Y') AS DATE)), lambda d: d IS NOT NULL) AS found,
         len(regexp_extract_all(date_range_raw, '{DATE}')) > 1 AS is_multi_date_beat
  FROM docs2),
docs AS (
  SELECT *, sha256(beat_url || chr(10) || incident_type || chr(10) || incident_text) AS raw_text_hash,
         CASE WHEN len(found) = 0 THEN []
              WHEN list_max(found) - list_min(found) > 31 THEN [list_min(found), list_max(found)]
              ELSE list_transform(range(0, list_max(found) - list_min(found) + 1),
                                  lambda i: list_min(found) + CAST(i AS INTEGER)) END AS incident_dates
  FROM docs3)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


def on_docs(select: str) -> str:
    return f"{with_(DOCS)}\n{select}"


def joined(dates: str = "incident_dates") -> str:
    return f"array_to_string(list_transform({dates}, lambda d: CAST(d AS VARCHAR)), ';')"


ORACLES["text_whitespace"] = f"SELECT doc_id, {ws('text')} AS clean FROM documents"
ORACLES["text_dash_fold"] = on_docs(f"SELECT o_orderkey, {fold('incident_text')} AS folded FROM docs")
ORACLES["type_normalize"] = on_docs(
    f"SELECT o_orderkey, {clean_type('incident_type')} AS clean, nullif(trim(incident_type), '') AS filled, "
    "nullif(beat_published_at, '') AS published FROM docs"
)
ORACLES["title_range"] = on_docs(
    f"SELECT o_orderkey, date_range_raw AS range, {range_of('bare')} AS bare_range "
    "FROM (SELECT *, replace(beat_title, '-', ' ') AS bare FROM docs)"
)
ORACLES["candidate_dates"] = on_docs(f"SELECT o_orderkey, {joined()} AS dates FROM docs")
ORACLES["multi_date_flag"] = on_docs("SELECT o_orderkey, is_multi_date_beat AS multi FROM docs")
ORACLES["occurred_repair"] = on_docs(
    "SELECT o_orderkey, CASE WHEN list_max(found) - list_min(found) > 31 THEN list_max(found) "
    "ELSE list_min(found) END AS occurred FROM docs"
)
ORACLES["content_hash"] = on_docs("SELECT o_orderkey, raw_text_hash AS digest FROM docs")
ORACLES["first_seen"] = (
    "SELECT sha256(text) AS digest, min(doc_id) AS doc_id, arg_min(source, doc_id) AS source "
    "FROM documents GROUP BY 1"
)
ORACLES["csv_flat"] = on_docs(
    f"SELECT beat_url, beat_title, nullif(beat_published_at, '') AS beat_published_at, date_range_raw, "
    f"nullif({joined()}, '') AS incident_dates, CAST(is_multi_date_beat AS VARCHAR) AS is_multi_date_beat, "
    "nullif(incident_type, '') AS incident_type, incident_text, raw_text_hash, "
    "strftime(scraped_at, '%Y-%m-%dT%H:%M:%S+00:00') AS scraped_at FROM docs"
)

# ---- lines to incidents ---------------------------------------------------------
REPORT = (
    f"replace(replace(replace(({items(samples.REPORTS)})[o_orderkey % {len(samples.REPORTS)} + 1], "
    "'{type}', incident_type), '{text}', incident_text), '{day}', strftime(day, '%m/%d/%Y'))"
)
NOISE = " OR ".join(f"starts_with(line, {lit(p)})" for p in C.NOISE_PREFIXES)


def flags(source: str, target: str) -> str:
    return rf"""
{target}0 AS (
  SELECT *, regexp_matches(line, '(?i)follow\s+us\s+on\s+facebook') AS is_marker,
         ({NOISE}) AS is_noise,
         starts_with(lower(line), 'police beat') OR regexp_matches(line, '{TITLE}') AS is_title
  FROM {source}),
{target}1 AS (
  SELECT *, {plausible('line')} AND NOT is_marker AND NOT is_title AS is_type FROM {target}0),
{target} AS MATERIALIZED (
  SELECT *, is_type AND NOT regexp_matches(line, '[.?!]$')
         AND lower(regexp_replace(split_part(line, ' ', 1), '[^A-Za-z'']+', '', 'g'))
             NOT IN {in_list(C.NARRATIVE_START_WORDS)} AS is_heading
  FROM {target}1)"""


def plausible(c: str) -> str:
    return (
        f"length({c}) BETWEEN 1 AND 100 AND len(string_split(trim({c}), ' ')) <= 10 "
        f"AND regexp_matches({c}, '[A-Za-z]') AND NOT regexp_matches({c}, '{DATE}')"
    )


LINES = rf"""
texts AS MATERIALIZED (
  SELECT 'd' || doc_id AS key, text FROM documents
  UNION ALL SELECT 'r' || o_orderkey, {REPORT} FROM docs0),
split0 AS MATERIALIZED (SELECT key, string_split_regex(text, '{BREAK}') AS parts FROM texts),
split1 AS MATERIALIZED (SELECT key, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS line_no FROM split0),
split AS MATERIALIZED (SELECT key, CAST(line_no AS INTEGER) AS line_no, {ws('raw')} AS line FROM split1)"""

# the kept lines of each key, and the incidents of either form
SEGMENTS = rf"""
cuts AS (SELECT key, min(line_no) AS cut FROM flagged WHERE is_marker GROUP BY key),
kept0 AS MATERIALIZED (
  SELECT f.* FROM flagged f LEFT JOIN cuts USING (key)
  WHERE (cut IS NULL OR line_no < cut) AND NOT is_noise),
ends AS (SELECT key, min(line_no) AS lo, max(line_no) AS hi FROM kept0 WHERE line <> '' GROUP BY key),
kept AS MATERIALIZED (
  SELECT k.*, sum(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY line_no) AS gap
  FROM kept0 k JOIN ends USING (key) WHERE line_no BETWEEN lo AND hi),
in_block AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY key, gap ORDER BY line_no) AS pos
  FROM kept WHERE line <> '' AND NOT is_title),
block0 AS (
  SELECT key, gap, {clean_type("max(line) FILTER (WHERE pos = 1)")} AS incident_type,
         {ws("string_agg(line, ' ' ORDER BY line_no) FILTER (WHERE pos > 1)")} AS incident_text
  FROM in_block GROUP BY key, gap HAVING count(*) >= 2),
block1 AS (
  SELECT * FROM block0
  WHERE {plausible('incident_type')} AND incident_text <> ''
    AND NOT regexp_matches(incident_type, '(?i)follow\s+us\s+on\s+facebook')
    AND NOT starts_with(lower(incident_type), 'police beat') AND NOT regexp_matches(incident_type, '{TITLE}')),
block_form AS MATERIALIZED (
  SELECT key, row_number() OVER (PARTITION BY key ORDER BY gap) - 1 AS incident_no, incident_type, incident_text
  FROM block1),
flat0 AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY line_no)
          - row_number() OVER (PARTITION BY key, is_heading ORDER BY line_no) AS run
  FROM kept WHERE line <> '' AND NOT is_title),
flat1 AS (
  SELECT *, is_heading AND row_number() OVER (PARTITION BY key, is_heading, run ORDER BY line_no) % 2 = 1 AS opens
  FROM flat0),
flat2 AS (
  SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY line_no) AS nr FROM flat1),
flat_form AS MATERIALIZED (
  SELECT key, nr - 1 AS incident_no, {clean_type("max(line) FILTER (WHERE opens)")} AS incident_type,
         {ws("string_agg(line, ' ' ORDER BY line_no) FILTER (WHERE NOT opens)")} AS incident_text
  FROM flat2 WHERE nr > 0 GROUP BY key, nr HAVING count(*) >= 2),
sizes AS MATERIALIZED (
  SELECT key, coalesce(b.n, 0) AS nb, coalesce(f.n, 0) AS nf
  FROM (SELECT key, count(*) AS n FROM block_form GROUP BY key) b
  FULL JOIN (SELECT key, count(*) AS n FROM flat_form GROUP BY key) f USING (key)),
picked AS (
  SELECT b.* FROM block_form b JOIN sizes USING (key) WHERE nf <= nb
  UNION ALL SELECT f.* FROM flat_form f JOIN sizes USING (key) WHERE nf > nb)"""

TEXT_LINES = with_(DOCS, LINES, flags("split", "flagged"), SEGMENTS)

ORACLES["line_flags"] = (
    with_(DOCS, LINES, flags("split", "flagged"))
    + " SELECT key, line_no, line, is_marker, is_noise, is_title, is_type, is_heading FROM flagged"
)
ORACLES["clean_lines"] = (
    TEXT_LINES
    + " SELECT key, coalesce(lines, '') AS lines FROM texts LEFT JOIN "
    "(SELECT key, string_agg(line, chr(10) ORDER BY line_no) AS lines FROM kept GROUP BY key) USING (key)"
)
ORACLES["blocks"] = (
    TEXT_LINES
    + " SELECT key, CAST(row_number() OVER (PARTITION BY key ORDER BY gap) - 1 AS INTEGER) AS block_no, block FROM "
    "(SELECT key, gap, string_agg(line, chr(10) ORDER BY line_no) AS block FROM kept WHERE line <> '' GROUP BY key, gap)"
)
_INCIDENT = " SELECT key, CAST(incident_no AS INTEGER) AS incident_no, incident_type, incident_text FROM "
ORACLES["block_incidents"] = TEXT_LINES + _INCIDENT + "block_form"
ORACLES["flat_incidents"] = TEXT_LINES + _INCIDENT + "flat_form"
ORACLES["pick_form"] = TEXT_LINES + _INCIDENT + "picked"

# ---- pages: the article's markup as lines ------------------------------------------
_BLOCK_TAG = "</?(?:p|div|section|article|li|h1|h2|h3)(?:\\s[^>]*)?>|<br\\s*/?>"
_ENTITIES = (("&amp;", "&"), ("&middot;", "·"), ("&copy;", "©"), ("&quot;", '"'), ("&lt;", "<"), ("&gt;", ">"))


def decoded(c: str) -> str:
    # the ampersand last, so that nothing is decoded twice
    for entity, char in (*_ENTITIES[1:], _ENTITIES[0]):
        c = f"replace({c}, {lit(entity)}, {lit(char)})"
    return c


ARTICLES = """
articles AS (SELECT url, regexp_extract(html, '(?s)<article>(.*)</article>', 1) AS body FROM pages)"""

PAGE_LINES = rf"""
broken AS (
  SELECT url, regexp_replace(regexp_replace(body, '{_BLOCK_TAG}', chr(10) || chr(10), 'g'),
                             '(?:<[^>]*>)+', chr(10), 'g') AS body FROM articles),
split0 AS MATERIALIZED (SELECT url AS key, string_split_regex(body, '{BREAK}') AS parts FROM broken),
split1 AS MATERIALIZED (SELECT key, unnest(parts) AS raw, generate_subscripts(parts, 1) - 1 AS line_no FROM split0),
split AS MATERIALIZED (SELECT key, CAST(line_no AS INTEGER) AS line_no, {ws(decoded('raw'))} AS line FROM split1)"""

ORACLES["page_lines"] = (
    with_(ARTICLES, PAGE_LINES, flags("split", "flagged"), SEGMENTS)
    + " SELECT key AS url, CAST(0 AS INTEGER) AS candidate_no, "
    "string_agg(line, chr(10) ORDER BY line_no) AS lines FROM kept WHERE line <> '' GROUP BY key"
)

# Paragraphs: a p runs to its own end tag, or, unclosed, to the end of the article.
PARAGRAPHS = rf"""
pieces0 AS (SELECT url, regexp_extract_all(body, '(?s)<[^>]*>|[^<]+') AS parts FROM articles),
pieces AS (
  SELECT url, piece, n, CASE WHEN piece = '<p>' THEN 1 WHEN piece = '</p>' THEN -1 ELSE 0 END AS step
  FROM (SELECT url, unnest(parts) AS piece, generate_subscripts(parts, 1) AS n FROM pieces0)),
depths AS (
  SELECT *, sum(step) OVER (PARTITION BY url ORDER BY n) AS depth FROM pieces),
opened AS (
  SELECT o.url, o.n AS lo, coalesce(min(c.n), 1000000000) AS hi
  FROM depths o LEFT JOIN depths c
    ON c.url = o.url AND c.n > o.n AND c.step = -1 AND c.depth = o.depth - 1
  WHERE o.step = 1 GROUP BY o.url, o.n),
paragraphs AS (
  SELECT o.url, o.lo, string_agg({ws(decoded('p.piece'))}, ' ' ORDER BY p.n) AS text
  FROM opened o JOIN pieces p ON p.url = o.url AND p.n > o.lo AND p.n < o.hi
  WHERE NOT starts_with(p.piece, '<') AND {ws(decoded('p.piece'))} <> ''
  GROUP BY o.url, o.lo),
lines AS (SELECT url, lo, {ws('text')} AS line FROM paragraphs),
paragraph_form AS (
  SELECT url, row_number() OVER (PARTITION BY url ORDER BY lo) - 1 AS paragraph_no, line AS incident_text
  FROM lines
  WHERE line <> '' AND NOT ({NOISE}) AND NOT regexp_matches(line, '(?i)follow\s+us\s+on\s+facebook')
    AND NOT starts_with(lower(line), 'police beat') AND NOT regexp_matches(line, '{TITLE}'))"""

ORACLES["paragraph_fallback"] = (
    with_(ARTICLES, PARAGRAPHS)
    + " SELECT url, CAST(paragraph_no AS INTEGER) AS paragraph_no, incident_text FROM paragraph_form"
)
FOUND_IN_PAGES = """
found AS (
  SELECT key AS url, CAST(incident_no AS INTEGER) AS incident_no, incident_type, incident_text FROM picked
  UNION ALL SELECT url, CAST(paragraph_no AS INTEGER), '', incident_text FROM paragraph_form
  WHERE url NOT IN (SELECT key FROM picked))"""
ORACLES["page_incidents"] = (
    with_(ARTICLES, PAGE_LINES, flags("split", "flagged"), SEGMENTS, PARAGRAPHS, FOUND_IN_PAGES)
    + " SELECT * FROM found"
)

# Report pages made of orders. Their nested containers hold the same incidents,
# so the first container by order of preference stands for all.
_PAGE = (
    f"replace(replace(replace(({items(samples.PAGES)})[o_orderkey % {len(samples.PAGES)} + 1], "
    "'{type}', incident_type), '{text}', incident_text), '{day}', strftime(day, '%m/%d/%Y'))"
)
_BODIES = (
    r"<div class=''RichTextArticleBody-body''>(.*?)</div>", "<article>(.*)</article>", "<main>(.*)</main>",
    "<section>(.*)</section>",
)
REPORT_ARTICLES = rf"""
report_pages AS (
  SELECT o_orderkey, 'https://beat.example/report/' || o_orderkey AS url, {_PAGE} AS html FROM docs0),
articles AS (
  SELECT url, regexp_replace(body, '(?s)<script>.*?</script>', '<script>', 'g') AS body
  FROM (SELECT url, coalesce({", ".join(f"nullif(regexp_extract(html, '(?s){b}', 1), '')" for b in _BODIES)}) AS body
        FROM report_pages) WHERE body IS NOT NULL)"""
REPORTED = (DOCS, REPORT_ARTICLES, PAGE_LINES, flags("split", "flagged"), SEGMENTS, PARAGRAPHS, FOUND_IN_PAGES)
ORACLES["report_page_incidents"] = with_(*REPORTED) + " SELECT * FROM found"
ORACLES["report_pages_skipped"] = (
    with_(*REPORTED) + " SELECT url FROM report_pages WHERE url NOT IN (SELECT url FROM found)"
)
ORACLES["pages_to_documents"] = (
    with_(*REPORTED)
    + " SELECT sha256(url || chr(10) || found.incident_type || chr(10) || found.incident_text) AS raw_text_hash, "
    f"url AS beat_url, found.incident_type, found.incident_text, {joined()} AS dates "
    "FROM found JOIN report_pages USING (url) JOIN docs USING (o_orderkey)"
)

# List pages made of orders: their markup again, taken apart with patterns
_ITEM = (
    "'<div class=item><a href=\"' || {url} || '\">' || {text} || '</a><i> ' || beat_published_at || ' </i></div>'"
)
LISTED = rf"""
lists AS (
  SELECT o_orderkey AS page_no, 'https://beat.example/?page=' || (o_orderkey + 1) AS next_page_url,
         {_ITEM.format(url="'/report/' || o_orderkey", text="beat_title")}
         || {_ITEM.format(url="'/other'", text="'Campus  news'")}
         || {_ITEM.format(url="'report/' || greatest(o_orderkey - 1, 0)", text="'POLICE&nbsp;Beat 01/02/1996 01/03/1996'")}
         AS html FROM docs),
parts AS (
  SELECT page_no, next_page_url, unnest(found) AS item, generate_subscripts(found, 1) - 1 AS item_no
  FROM (SELECT *, regexp_extract_all(html, '<div class=item>.*?</div>') AS found FROM lists)),
links AS (
  SELECT page_no, CAST(item_no AS INTEGER) AS item_no,
         'https://beat.example/' || ltrim(regexp_extract(item, 'href="([^"]*)"', 1), '/') AS url,
         {ws("replace(regexp_extract(item, '<a[^>]*>([^<]*)</a>', 1), '&nbsp;', ' ')")} AS title,
         {ws("regexp_extract(item, '<i>([^<]*)</i>', 1)")} AS published_at, next_page_url
  FROM parts),
listed0 AS (SELECT *, {range_of('title')} AS date_range_raw FROM links WHERE starts_with(lower(title), 'police beat')),
listed AS (
  SELECT *, len(regexp_extract_all(date_range_raw, '{DATE}')) > 1 AS is_multi_date_beat FROM listed0)"""
ORACLES["list_items"] = with_(DOCS, LISTED) + " SELECT * FROM listed"
ORACLES["report_summaries"] = (
    with_(DOCS, LISTED)
    + " SELECT * EXCLUDE (next_page_url) FROM listed "
    "QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_no, item_no) = 1"
)

# ---- classification -----------------------------------------------------------------
RULE_OF = "CASE " + " ".join(
    f"WHEN regexp_matches(t, {lit('(?i)' + pattern)}) THEN {i}" for i, (pattern, _) in enumerate(C.DEFAULT.place_rules)
) + " END"
LOT = r"(?i)\blot\s*#?\s*(\d+)"
NOUNS = r"\b(?:" + "|".join(C.PLACE_NOUNS) + r")\b"
LOT_OF = "CASE lot " + " ".join(f"WHEN {n} THEN {lit(z)}" for n, z in C.LOT_ZONES.items()) + " END"
RULE_ZONES = items(z for _, z in C.DEFAULT.place_rules)
RULE_PATTERNS = items("(?i)" + p for p, _ in C.DEFAULT.place_rules)

LOOKUP = rf"""
folded AS (SELECT *, {fold('incident_text')} AS t FROM docs),
ruled AS (
  SELECT *, {RULE_OF} AS rule, TRY_CAST(regexp_extract(t, '{LOT}', 1) AS BIGINT) AS lot FROM folded),
looked AS (
  SELECT *, CASE WHEN rule IS NOT NULL THEN ({RULE_ZONES})[rule + 1] ELSE {LOT_OF} END AS hit_zone,
         CASE WHEN rule IS NOT NULL THEN 'landmark' WHEN {LOT_OF} IS NOT NULL THEN 'lot' END AS hit_source,
         CASE WHEN rule IS NOT NULL THEN regexp_extract(t, ({RULE_PATTERNS})[rule + 1], 0) END AS matched,
         regexp_matches(t, '{NOUNS}') AS named
  FROM ruled),
hits AS (
  SELECT *, CASE hit_source WHEN 'landmark' THEN 'matched ''' || matched || ''''
                            WHEN 'lot' THEN 'parking Lot ' || lot END AS hit_reason
  FROM looked),
classified AS (
  SELECT *, coalesce(hit_zone, 'UNKNOWN') AS location_zone, coalesce(hit_source, 'none') AS location_source,
         CASE WHEN hit_source IS NULL THEN 'NONE' ELSE 'HIGH' END AS location_confidence
  FROM hits)"""

MODELED = rf"""
asked AS (
  SELECT *, ({items([*C.ZONE_ATTRIBUTES, 'NORTH_QUAD'])})[length(t) % {len(C.ZONE_ATTRIBUTES) + 1} + 1] AS answer FROM hits),
modeled AS (
  SELECT *, CASE WHEN answer IN {in_list(C.ZONE_ATTRIBUTES)} THEN answer ELSE 'UNKNOWN' END AS proposed FROM asked),
decided AS (
  SELECT *, CASE WHEN hit_zone IS NOT NULL THEN hit_zone WHEN proposed = 'UNKNOWN' OR NOT named THEN 'UNKNOWN'
              ELSE proposed END AS zone,
         CASE WHEN hit_zone IS NOT NULL THEN hit_source WHEN proposed = 'UNKNOWN' THEN 'llm'
              WHEN NOT named THEN 'guardrail' ELSE 'llm' END AS source,
         CASE WHEN hit_zone IS NOT NULL THEN hit_reason
              WHEN proposed = 'UNKNOWN' THEN 'model found no explicit location'
              WHEN NOT named THEN 'model proposed ' || proposed || ' but text names no explicit place'
              ELSE 'model matched an explicit place' END AS reasoning
  FROM modeled)"""


def on_lookup(select: str, *more: str) -> str:
    return f"{with_(DOCS, LOOKUP, *more)}\n{select}"


ORACLES["rule_match"] = on_lookup(
    f"SELECT o_orderkey, rule, ({RULE_ZONES})[rule + 1] AS zone, matched FROM looked"
)
ORACLES["lot_lookup"] = on_lookup(f"SELECT o_orderkey, lot, {LOT_OF} AS zone FROM looked")
ORACLES["deterministic"] = on_lookup(
    "SELECT o_orderkey, hit_zone AS zone, hit_source AS source, hit_reason AS reasoning FROM hits"
)
ORACLES["explicit_place"] = on_lookup("SELECT o_orderkey, named FROM looked")
ORACLES["guarded"] = on_lookup("SELECT o_orderkey, zone, source, reasoning FROM decided", MODELED)
ORACLES["confidence_tier"] = on_lookup(
    "SELECT o_orderkey, CASE source WHEN 'landmark' THEN 'HIGH' WHEN 'lot' THEN 'HIGH' WHEN 'llm' THEN 'MEDIUM' "
    "ELSE 'NONE' END AS confidence FROM decided",
    MODELED,
)
ORACLES["source_counts"] = on_lookup(
    "SELECT location_source, count(*) AS incidents FROM classified GROUP BY 1"
)
ORACLES["pending_only"] = on_lookup(
    "SELECT raw_text_hash, CASE WHEN raw_text_hash < '8' THEN 'MTC' ELSE location_zone END AS location_zone, "
    "CASE WHEN raw_text_hash < '8' THEN NULL ELSE location_confidence END AS location_confidence, "
    "CASE WHEN raw_text_hash < '8' THEN NULL ELSE location_source END AS location_source FROM classified"
)
ORACLES["pending_limit"] = on_lookup(
    "SELECT CASE WHEN raw_text_hash < '8' THEN 'MTC' WHEN raw_text_hash IN (SELECT raw_text_hash FROM chosen) "
    "THEN location_zone END AS location_zone, count(*) AS documents FROM classified GROUP BY 1",
    "chosen AS (SELECT DISTINCT raw_text_hash FROM classified WHERE raw_text_hash >= '8' ORDER BY 1 LIMIT 100)",
)

# ---- normalization ---------------------------------------------------------------------
_ENDS = (
    "CASE WHEN len(incident_dates) > 0 THEN list_min(incident_dates) END AS earliest_date, "
    "CASE WHEN len(incident_dates) > 0 THEN list_max(incident_dates) END AS latest_date"
)
_INCIDENT_COLUMNS = (
    "raw_text_hash, beat_url, incident_type, incident_text, location_zone, location_confidence, location_source, "
    f"is_multi_date_beat, {_ENDS}"
)
_BEAT_COLUMNS = "beat_url, beat_title, nullif(beat_published_at, '') AS published_at, date_range_raw"
# the last write of a key, NULL below every value
_LAST_DOC = (
    "row_number() OVER (PARTITION BY raw_text_hash ORDER BY scraped_at DESC, beat_title DESC, date_range_raw DESC) = 1"
)
_LAST_BEAT = (
    "row_number() OVER (PARTITION BY beat_url ORDER BY scraped_at DESC, beat_title DESC, date_range_raw DESC, "
    "nullif(beat_published_at, '') DESC NULLS LAST) = 1"
)
ORACLES["norm_pending"] = on_lookup(
    "SELECT beat_url, count(*) AS documents FROM classified WHERE NOT is_multi_date_beat GROUP BY 1"
)
ORACLES["norm_limit"] = on_lookup(
    "SELECT raw_text_hash, is_multi_date_beat OR raw_text_hash IN (SELECT DISTINCT raw_text_hash FROM classified "
    "WHERE NOT is_multi_date_beat ORDER BY 1 LIMIT 200) AS normalized, count(*) AS documents FROM classified GROUP BY 1, 2"
)
ORACLES["norm_snapshot"] = on_lookup(
    "SELECT table_name, key, row, count(*) AS rows FROM ("
    "SELECT 'beats' AS table_name, beat_url AS key, beat_title || '|' || coalesce(nullif(beat_published_at, ''), '-') "
    f"|| '|' || date_range_raw AS row FROM (SELECT * FROM docs QUALIFY {_LAST_BEAT}) "
    "UNION ALL SELECT 'incidents', raw_text_hash, location_zone || '|' || coalesce(CAST(earliest_date AS VARCHAR), '-') "
    "|| '|' || coalesce(CAST(latest_date AS VARCHAR), '-') "
    f"FROM (SELECT {_INCIDENT_COLUMNS} FROM classified QUALIFY {_LAST_DOC}) "
    "UNION ALL SELECT 'incident_dates', raw_text_hash, CAST(unnest(incident_dates) AS VARCHAR) "
    f"FROM (SELECT * FROM classified QUALIFY {_LAST_DOC}) "
    "UNION ALL SELECT 'raw_incidents', raw_text_hash, 'true' FROM classified) GROUP BY 1, 2, 3"
)
ORACLES["norm_beats"] = on_docs(f"SELECT {_BEAT_COLUMNS} FROM docs")
ORACLES["norm_incidents"] = on_lookup(f"SELECT {_INCIDENT_COLUMNS} FROM classified")
ORACLES["norm_dates"] = on_docs("SELECT raw_text_hash, unnest(incident_dates) AS incident_date FROM docs")

BATCHES = """
old0 AS (SELECT *, 'UNKNOWN' AS location_zone, 'NONE' AS location_confidence, 'none' AS location_source
         FROM docs WHERE o_orderkey % 3 <> 0),
new0 AS (SELECT * REPLACE (beat_title || ' (updated)' AS beat_title, incident_dates[1:1] AS incident_dates),
                'MTC' AS location_zone, 'NONE' AS location_confidence, 'none' AS location_source
         FROM docs WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)"""


def on_batches(select: str) -> str:
    return f"{with_(DOCS, BATCHES)}\n{select}"


ORACLES["idempotent_insert"] = on_batches(
    "SELECT raw_text_hash, o_orderkey, beat_url FROM new0 "
    "WHERE raw_text_hash NOT IN (SELECT raw_text_hash FROM old0) "
    "QUALIFY row_number() OVER (PARTITION BY raw_text_hash ORDER BY o_orderkey) = 1"
)
ORACLES["insert_counts"] = on_batches(
    "SELECT count(DISTINCT raw_text_hash) FILTER (WHERE fresh) AS inserted, "
    "count(*) - count(DISTINCT raw_text_hash) FILTER (WHERE fresh) AS skipped, CAST(0 AS BIGINT) AS rejected FROM "
    "(SELECT raw_text_hash, raw_text_hash NOT IN (SELECT raw_text_hash FROM old0) AS fresh FROM new0)"
)
ORACLES["upsert_beats"] = on_batches(
    f"SELECT {_BEAT_COLUMNS} FROM (SELECT * FROM new0 QUALIFY {_LAST_BEAT}) UNION ALL "
    f"SELECT {_BEAT_COLUMNS} FROM (SELECT * FROM old0 QUALIFY {_LAST_BEAT}) "
    "WHERE beat_url NOT IN (SELECT beat_url FROM new0)"
)
_MERGED = (
    f"(SELECT * FROM new0 QUALIFY {_LAST_DOC} UNION ALL "
    f"SELECT * FROM (SELECT * FROM old0 QUALIFY {_LAST_DOC}) WHERE raw_text_hash NOT IN (SELECT raw_text_hash FROM new0))"
)
ORACLES["upsert_incidents"] = on_batches(f"SELECT {_INCIDENT_COLUMNS} FROM {_MERGED}")
ORACLES["replace_dates"] = on_batches(
    f"SELECT raw_text_hash, unnest(incident_dates) AS incident_date FROM {_MERGED}"
)
ORACLES["mark_normalized"] = on_docs(
    "SELECT o_orderkey, raw_text_hash IN (SELECT raw_text_hash FROM docs WHERE o_orderkey % 2 = 0) AS normalized FROM docs"
)

# ---- star schema ---------------------------------------------------------------------------
TYPE_CASE = "CASE " + " ".join(
    f"WHEN regexp_matches(incident_type, {lit('(?i)' + p)}) THEN {lit(c)}" for p, c in C.CATEGORY_RULES
) + " ELSE 'Other' END"
ZONE_ROWS = ", ".join(
    f"({lit(z)}, {lit(a[0])}, {a[1]}, {a[2]}, {a[3]}, {z == C.UNKNOWN})" for z, a in C.ZONE_ATTRIBUTES.items()
)

STAR = rf"""
incidents AS (SELECT * FROM classified QUALIFY {_LAST_DOC}),
beats AS (SELECT * FROM docs QUALIFY {_LAST_BEAT}),
stg AS (
  SELECT raw_text_hash AS incident_id, beat_url, nullif(trim(incident_type), '') AS incident_type, incident_text,
         location_zone, location_confidence, location_source, is_multi_date_beat, earliest_date, latest_date,
         CASE WHEN latest_date - earliest_date > 31 THEN latest_date ELSE earliest_date END AS occurred_date
  FROM (SELECT {_INCIDENT_COLUMNS} FROM incidents)),
terms AS (
  SELECT y, label || ' ' || y AS label, make_date(y, m1, d1) AS s, make_date(y, m2, d2) AS e,
         make_date(y + later, m3, d3) AS nxt
  FROM (SELECT CAST(unnest(range(1995, 2002)) AS INTEGER) AS y),
       (VALUES ('Winter Semester', 1, 8, 4, 22, 0, 4, 29), ('Spring Term', 4, 29, 6, 18, 0, 6, 24),
               ('Summer Term', 6, 24, 8, 13, 0, 9, 3), ('Fall Semester', 9, 3, 12, 17, 1, 1, 8))
       AS t(label, m1, d1, m2, d2, later, m3, d3)),
calendar AS (
  SELECT 'SEMESTER' AS period_type, label, s AS start_date, e AS end_date FROM terms
  UNION ALL SELECT 'FINALS', label || ' Finals', e - 4, e FROM terms
  UNION ALL SELECT 'BREAK', 'Break after ' || label, e + 1, nxt - 1 FROM terms
  UNION ALL SELECT 'GAME_DAY', 'Home game', make_date(y, 9, 12), make_date(y, 9, 12) FROM (SELECT DISTINCT y FROM terms)
  UNION ALL SELECT 'GAME_DAY', 'Home game', make_date(y, 10, 17), make_date(y, 10, 17) FROM (SELECT DISTINCT y FROM terms)),
days AS (
  SELECT CAST(unnest(generate_series(min(occurred_date), max(occurred_date), INTERVAL 1 DAY)) AS DATE) AS date_day FROM stg),
inside AS (
  SELECT date_day, list(DISTINCT period_type) AS kinds, min(label) FILTER (WHERE period_type = 'SEMESTER') AS semester
  FROM days JOIN calendar ON date_day BETWEEN start_date AND end_date GROUP BY date_day),
dim_date AS (
  SELECT date_day, CAST(isodow(date_day) AS INTEGER) AS day_of_week, dayname(date_day) AS day_name,
         dayname(date_day) LIKE 'S%day' AS is_weekend, semester,
         {", ".join(f"coalesce(list_contains(kinds, '{k}'), false) AS {n}" for k, n in (("FINALS", "is_finals"), ("BREAK", "is_break"), ("GAME_DAY", "is_game_day")))}
  FROM days LEFT JOIN inside USING (date_day)),
zones (location_zone, zone_label, is_residential, is_academic, is_on_campus, is_unknown) AS (
  VALUES {ZONE_ROWS}),
dim_location AS (
  SELECT z.location_zone, coalesce(zone_label, 'Unknown') AS zone_label, is_residential, is_academic, is_on_campus, is_unknown
  FROM (SELECT DISTINCT location_zone FROM stg) z LEFT JOIN zones USING (location_zone)),
dim_type AS (
  SELECT incident_type, {TYPE_CASE} AS incident_category
  FROM (SELECT DISTINCT incident_type FROM stg WHERE incident_type IS NOT NULL)),
daily AS (
  SELECT d.date_day, d.day_name, d.is_weekend, d.semester, d.is_finals, d.is_break, d.is_game_day,
         count(f.incident_id) AS total_incidents,
         count(f.incident_id) FILTER (WHERE f.location_zone <> 'UNKNOWN') AS located_incidents,
         count(DISTINCT f.location_zone) FILTER (WHERE f.location_zone <> 'UNKNOWN') AS distinct_zones
  FROM dim_date d LEFT JOIN stg f ON f.occurred_date = d.date_day GROUP BY 1, 2, 3, 4, 5, 6, 7)"""


def on_star(select: str, *more: str) -> str:
    return f"{with_(DOCS, LOOKUP, STAR, *more)}\n{select}"


ORACLES["stg_beats"] = on_star(
    "SELECT beat_url, nullif(trim(beat_title), '') AS beat_title, nullif(trim(beat_published_at), '') AS published_at, "
    "date_range_raw FROM beats"
)
ORACLES["stg_incidents"] = on_star("SELECT * FROM stg")
ORACLES["stg_incident_dates"] = on_star(
    "SELECT raw_text_hash AS incident_id, unnest(incident_dates) AS incident_date FROM incidents"
)
ORACLES["date_bounds"] = on_star(
    "SELECT min(occurred_date) AS min_date, max(occurred_date) AS max_date FROM stg"
)
ORACLES["dim_date"] = on_star("SELECT * FROM dim_date")
ORACLES["dim_location"] = on_star("SELECT * FROM dim_location")
ORACLES["dim_incident_type"] = on_star("SELECT * FROM dim_type")
ORACLES["fct_incidents"] = on_star(
    "SELECT incident_id, occurred_date, location_zone, incident_type, beat_url, location_source, location_confidence, "
    "incident_text, CAST(1 AS INTEGER) AS incident_count FROM stg"
)
ORACLES["daily_summary"] = on_star("SELECT * FROM daily")

# ---- data quality ----------------------------------------------------------------------------
ORACLES["check_unique"] = "SELECT o_custkey, count(*) AS copies FROM orders GROUP BY 1 HAVING count(*) > 1"
ORACLES["check_not_null"] = on_docs("SELECT o_orderkey FROM docs WHERE trim(incident_type) = ''")
ORACLES["check_accepted"] = (
    "SELECT c_mktsegment, count(*) AS rows FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY') GROUP BY 1"
)
ORACLES["check_relationship"] = (
    "SELECT child AS key, count(*) AS rows FROM (SELECT CASE WHEN o_orderkey % 7 = 0 THEN -1 - o_custkey "
    "ELSE o_custkey END AS child FROM orders) WHERE child NOT IN (SELECT c_custkey FROM customer) GROUP BY 1"
)
_KEYS = (
    ("beats", "beat_url", "beats"), ("incidents", "raw_text_hash", "incidents"), ("stg_incidents", "incident_id", "stg"),
    ("stg_beats", "beat_url", "beats"), ("dim_date", "date_day", "dim_date"),
    ("dim_location", "location_zone", "dim_location"), ("dim_incident_type", "incident_type", "dim_type"),
    ("fct_incidents", "incident_id", "stg"), ("mart_daily_summary", "date_day", "daily"),
)


def _failures(kind: str, table: str, column: str, body: str) -> str:
    return f"SELECT '{kind}' AS check_kind, '{table}' AS table_name, '{column}' AS column_name, ({body}) AS failures"


ORACLES["check_suite"] = on_star(
    "\nUNION ALL ".join(
        [
            *[
                _failures("unique", t, c, f"SELECT count(*) FROM (SELECT {c} FROM {s} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
                for t, c, s in _KEYS
            ],
            *[_failures("not_null", t, c, f"SELECT count(*) FROM {s} WHERE {c} IS NULL") for t, c, s in _KEYS],
            *[
                _failures("not_null", "academic_calendar", c, f"SELECT count(*) FROM calendar WHERE {c} IS NULL")
                for c in ("start_date", "end_date")
            ],
            _failures("accepted_values", "stg_incidents", "location_zone",
                      f"SELECT count(DISTINCT location_zone) FROM stg WHERE location_zone NOT IN {in_list(C.ZONE_ATTRIBUTES)}"),
            _failures("accepted_values", "academic_calendar", "period_type",
                      f"SELECT count(DISTINCT period_type) FROM calendar WHERE period_type NOT IN {in_list(C.PERIOD_TYPES)}"),
            *[
                _failures("relationships", t, c, f"SELECT count(*) FROM {s} x LEFT JOIN {p} y ON x.{xc} = y.{k} WHERE x.{xc} IS NOT NULL AND y.{k} IS NULL")
                for t, c, s, xc, p, k in (
                    ("stg_incidents", "beat_url", "stg", "beat_url", "beats", "beat_url"),
                    ("stg_incident_dates", "incident_id", "incidents", "raw_text_hash", "stg", "incident_id"),
                    ("fct_incidents", "location_zone", "stg", "location_zone", "dim_location", "location_zone"),
                    ("fct_incidents", "incident_type", "stg", "incident_type", "dim_type", "incident_type"),
                    ("fct_incidents", "occurred_date", "stg", "occurred_date", "dim_date", "date_day"),
                )
            ],
        ]
    )
)
ORACLES["check_suite_failures"] = (
    "\nUNION ALL ".join(
        [
            _failures("unique", "orders", "o_orderkey", "SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)"),
            _failures("unique", "orders", "o_custkey", "SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1)"),
            _failures("not_null", "orders", "o_orderdate", "SELECT count(*) FROM orders WHERE o_orderdate IS NULL"),
            _failures("accepted_values", "orders", "o_orderstatus", "SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')"),
            _failures("relationships", "customer", "c_nationkey", "SELECT count(*) FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)"),
            _failures("accepted_values", "customer", "c_mktsegment", "SELECT count(DISTINCT c_mktsegment) FROM customer"),
            _failures("relationships", "strays", "c_nationkey", "SELECT count(*) FROM customer WHERE c_custkey % 7 = 0 AND -1 - c_nationkey NOT IN (SELECT n_nationkey FROM nation)"),
        ]
    )
)

# ---- reports -----------------------------------------------------------------------------------
DETAIL = """
detail AS (
  SELECT f.occurred_date AS date, l.zone_label AS zone, l.is_unknown AS zone_unknown,
         coalesce(t.incident_category, 'Uncategorized') AS category, f.incident_type AS type,
         f.incident_text AS narrative, d.semester AS semester, coalesce(d.is_finals, false) AS is_finals,
         coalesce(d.is_break, false) AS is_break, coalesce(d.is_game_day, false) AS is_game_day,
         coalesce(d.is_weekend, false) AS is_weekend
  FROM stg f JOIN dim_location l USING (location_zone) LEFT JOIN dim_type t USING (incident_type)
       LEFT JOIN dim_date d ON d.date_day = f.occurred_date),
spine AS (SELECT date_day, semester, is_finals, is_break, is_game_day, is_weekend FROM daily),
outliers AS (
  SELECT date, count(*) AS incidents FROM detail WHERE date IS NOT NULL GROUP BY 1
  HAVING count(*) > (SELECT floor(m + 2.4 * sqrt(m)) FROM (SELECT 6.237::DOUBLE * ((max(o_orderkey) - 1) // 15000 + 1) AS m FROM orders))),
usual AS (SELECT * FROM detail WHERE date IS NULL OR date NOT IN (SELECT date FROM outliers)),
usual_days AS (SELECT * FROM spine WHERE date_day NOT IN (SELECT date FROM outliers)),
chosen AS (
  SELECT * FROM usual
  WHERE (date IS NULL OR date BETWEEN DATE '1996-03-01' AND DATE '1998-06-30')
    AND semester IN ('Winter Semester 1996', 'Fall Semester 1996', 'Winter Semester 1997', 'Fall Semester 1997')
    AND zone IN ('Academic Core', 'Stadium / Athletics', 'Helaman Halls', 'Unknown')
    AND category IN ('Property', 'Medical', 'Traffic', 'Uncategorized')),
chosen_days AS (
  SELECT * FROM usual_days
  WHERE date_day BETWEEN DATE '1996-03-01' AND DATE '1998-06-30'
    AND semester IN ('Winter Semester 1996', 'Fall Semester 1996', 'Winter Semester 1997', 'Fall Semester 1997'))"""
FOUND = "regexp_matches(narrative, '(?i)alarm|lot #?[0-9]+')"


def trend(detail: str, days: str) -> str:
    return f"""
counted AS (
  SELECT date_day, coalesce(n, 0) AS incidents,
         CASE WHEN is_finals THEN 'Finals' WHEN is_break THEN 'Break' WHEN is_game_day THEN 'Game day'
              ELSE 'Regular' END AS day_type
  FROM {days} LEFT JOIN (SELECT date, count(*) AS n FROM {detail} WHERE date IS NOT NULL GROUP BY 1) ON date = date_day),
windowed AS (
  SELECT *, avg(incidents) OVER (ORDER BY date_day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean FROM counted)"""


def even(c: str) -> str:
    """Two decimals, a tie to the even neighbour."""
    return (
        f"CASE WHEN {c} * 100 - floor({c} * 100) = 0.5 THEN 2 * floor((floor({c} * 100) + 1) / 2) / 100.0 "
        f"ELSE round({c} * 100) / 100.0 END"
    )


def on_detail(select: str, *more: str) -> str:
    return on_star(select, DETAIL, *more)


ORACLES["incident_detail"] = on_detail("SELECT * FROM detail")
ORACLES["spine"] = on_detail("SELECT * FROM spine")
ORACLES["outlier_days"] = on_detail("SELECT * FROM outliers")
ORACLES["outliers_excluded"] = on_detail("SELECT date, zone, category, type, narrative FROM usual")
ORACLES["spine_filtered"] = on_detail("SELECT * FROM chosen_days")
ORACLES["filtered"] = on_detail("SELECT * FROM chosen")
ORACLES["search"] = on_detail(f"SELECT * FROM usual WHERE {FOUND}")
ORACLES["search_literal"] = on_detail("SELECT * FROM usual WHERE contains(lower(narrative), 'lot #41.')")
ORACLES["headline"] = on_detail(
    "SELECT count(*) AS incidents, count(*) / greatest((SELECT count(*) FROM chosen_days), 1) AS incidents_per_day, "
    "count(DISTINCT zone) FILTER (WHERE NOT zone_unknown) AS zones FROM chosen"
)
_TREND = f"SELECT date_day, incidents, day_type, {even('mean')} AS rolling FROM windowed"
ORACLES["daily_trend"] = on_detail(_TREND, trend("chosen", "chosen_days"))
ORACLES["daily_trend_all"] = on_detail(_TREND, trend("usual", "usual_days"))
ORACLES["calendar_effect"] = on_detail(
    f"SELECT day_type, {even('avg(incidents)')} AS avg_per_day, count(*) AS days, CAST(sum(incidents) AS BIGINT) AS total "
    "FROM counted GROUP BY 1",
    trend("usual", "usual_days"),
)
ORACLES["by_zone"] = on_detail("SELECT zone, count(*) AS incidents FROM usual WHERE NOT zone_unknown GROUP BY 1")
ORACLES["by_category"] = on_detail("SELECT category, count(*) AS incidents FROM usual GROUP BY 1")
ORACLES["zone_category_grid"] = on_detail(
    "SELECT zone, category, count(*) AS incidents FROM usual WHERE NOT zone_unknown GROUP BY 1, 2"
)
ORACLES["weekday_profile"] = on_detail(
    f"SELECT w.weekday, count(date) AS incidents FROM (SELECT unnest({items(C.WEEKDAYS)}) AS weekday) w "
    "LEFT JOIN usual ON dayname(date) = w.weekday GROUP BY 1"
)
ORACLES["filter_options"] = on_detail(
    "SELECT DISTINCT 'semester' AS filter, semester AS value FROM usual WHERE semester IS NOT NULL "
    "UNION ALL SELECT DISTINCT 'zone', zone FROM usual UNION ALL SELECT DISTINCT 'category', category FROM usual"
)
ORACLES["spine_bounds"] = on_detail(
    "SELECT min(date_day) AS first_day, max(date_day) AS last_day FROM usual_days"
)
ORACLES["explorer"] = on_detail(
    'SELECT date AS "Date", zone AS "Zone", category AS "Category", type AS "Type", narrative AS "Narrative" '
    f"FROM chosen WHERE {FOUND}"
)
ORACLES["explorer_counts"] = on_detail(
    f"SELECT (SELECT count(*) FROM chosen WHERE {FOUND}) AS matched, (SELECT count(*) FROM usual) AS total"
)

# ---- incremental ---------------------------------------------------------------------------------
ORACLES["incremental_run"] = on_lookup(
    f"SELECT {_INCIDENT_COLUMNS} FROM classified QUALIFY {_LAST_DOC}"
)
