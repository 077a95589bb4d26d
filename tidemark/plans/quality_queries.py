"""Data-quality rules on tables that break them: documents as items, lineitems as their sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TIERS
from ..functions import times
from ..operators import quality, types
from ..sources import documents
from . import bindings as b
from .learn_queries import GAPS
from .registry import cte, query
from .view_queries import day

TOPICS = ("en", "fr", "de")
KNOWN = {f"supplier-{i:09d}.example.com": (f"Supplier {i}", TIERS[i % 3]) for i in range(1, 10)}

# ---- items ---------------------------------------------------------------------------------
cte("draft_sources", """
SELECT 'doc-' || l_orderkey AS id, l_orderkey AS doc_id, l_linenumber AS pos, l_partkey AS part_key,
       CASE WHEN l_partkey % 40 = 0 THEN 'ftp://' ELSE 'https://' END || lower(replace(s_name, '#', '-')) || '.example.com/' || l_partkey AS url, s_suppkey,
       CASE WHEN l_partkey % 33 = 0 THEN '' ELSE s_name END AS outlet,
       CASE l_suppkey % 5 WHEN 0 THEN 'primary' WHEN 1 THEN 'press' WHEN 2 THEN 'trade' WHEN 3 THEN 'social' ELSE 'blog' END AS tier,
       CASE WHEN l_partkey % 29 = 0 THEN 'xx' WHEN l_returnflag = 'A' THEN 'en' WHEN l_returnflag = 'R' THEN 'zh' ELSE 'other' END AS lang
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN documents ON doc_id = l_orderkey
""")
cte("draft_facts", """
SELECT doc_id, count(*) AS n_sources, bool_and(tier = 'social') AS all_social, coalesce(bool_or(lang = 'zh') FILTER (WHERE url LIKE 'https%'), false) AS has_zh
FROM draft_sources GROUP BY doc_id
""")
cte("drafts", """
SELECT h.*, CASE WHEN h.id % 19 = 0 THEN 'Doc_' ELSE 'doc-' END || h.id AS item_id, CASE WHEN h.id % 7 > 0 THEN 'because' END AS why,
       CASE WHEN h.id % 11 > 0 THEN 1 ELSE 0 END AS n_entities, CASE WHEN h.id % 8 = 0 THEN 1 ELSE 0 END AS blank_ticker, h.id % 9 AS n_numbers,
       n_chars / CAST(20000 AS DOUBLE) AS impact, (h.id % 13) / CAST(10 AS DOUBLE) AS novelty, h.id % 10 AS coverage, h.id % 17 > 0 AS zoned,
       CAST(date_trunc('week', published_at) AS TIMESTAMP) + INTERVAL 3 HOUR AS ws, CAST(date_trunc('week', published_at) AS TIMESTAMP) + INTERVAL 120 HOUR AS we
FROM headlines h
""")


def drafts(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("id")
    monday = F.date_trunc("week", "published_at").cast("timestamp")
    stamp = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss")
    return b.headlines(spark, sf).select(
        F.concat(F.when(i % 19 == 0, "Doc_").otherwise("doc-"), i.cast("string")).alias("id"),
        "title", F.col("text").alias("summary"), F.when(i % 7 > 0, "because").alias("why_it_matters"),
        F.when(i % 2 == 0, F.col("title")).alias("original_title"), F.col("lang").alias("topic"), F.col("tier").alias("region"),
        F.when(i % 11 > 0, F.array("outlet")).otherwise(F.array().cast("array<string>")).alias("entities"),
        F.when(i % 8 == 0, F.array(F.lit("ABC"), F.lit(""))).alias("tickers"),
        F.array_repeat(F.lit("7%"), (i % 9).cast("int")).alias("key_numbers"),
        (F.col("n_chars") / F.lit(20000.0)).alias("impact"), ((i % 13) / F.lit(10.0)).alias("novelty"), (i % 10).alias("coverage"),
        F.concat(stamp, F.when(i % 17 > 0, "Z").otherwise("")).alias("published_at"),
        (monday + F.make_dt_interval(hours=F.lit(3))).alias("window_start"), (monday + F.make_dt_interval(hours=F.lit(120))).alias("window_end"),
        "issue_date",
    )


def draft_sources(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents").select(F.col("doc_id").alias("l_orderkey"))
    p = F.col("l_partkey")
    line = b.table(spark, sf, "lineitem").join(docs, "l_orderkey").join(b.table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    name = F.lower(F.replace("s_name", F.lit("#"), F.lit("-")))
    prefix = F.when(F.col("l_orderkey") % 19 == 0, "Doc_").otherwise("doc-")
    return line.select(
        F.concat(prefix, F.col("l_orderkey").cast("string")).alias("id"), F.col("l_orderkey").alias("doc_id"),
        F.col("l_linenumber").alias("pos"), p.alias("part_key"),
        F.concat(F.when(p % 40 == 0, "ftp://").otherwise("https://"), name, F.lit(".example.com/"), p.cast("string")).alias("url"),
        F.when(p % 33 == 0, "").otherwise(F.col("s_name")).alias("outlet"),
        b.one_of(F.col("l_suppkey"), ("primary", "press", "trade", "social", "blog")).alias("tier"),
        F.when(p % 29 == 0, "xx").when(F.col("l_returnflag") == "A", "en").when(F.col("l_returnflag") == "R", "zh").otherwise("other").alias("lang"),
    )


def _rules_sql(table: str, keys: str, rules: list[tuple[str, str, str]]) -> str:
    checks = ", ".join(f"CASE WHEN {cond} THEN {{'rule': '{name}', 'severity': '{sev}'}} END" for name, sev, cond in rules)
    return f"SELECT {keys}, v.rule, v.severity FROM (SELECT {keys}, unnest([{checks}]) AS v FROM {table}) WHERE v IS NOT NULL"


cte("checked_drafts", """
SELECT d.*, n_sources, coalesce(all_social, false) AS all_social, coalesce(has_zh, false) AS has_zh,
       zoned AND published_at BETWEEN ws - INTERVAL 6 HOUR AND we AS graced, zoned AND published_at BETWEEN ws AND we AS inside
FROM drafts d LEFT JOIN draft_facts f ON f.doc_id = d.id
""")
_ITEM_SQL = _rules_sql("checked_drafts", "item_id, issue_date", [
    ("id is not kebab-case", "error", "item_id LIKE 'D%'"),
    ("missing title", "error", "title = ''"), ("missing summary", "error", "text = ''"), ("missing why_it_matters", "error", "why IS NULL"),
    ("title is long", "warning", "length(title) > 140"),
    ("unknown topic", "error", "lang NOT IN ('en', 'fr', 'de')"), ("unknown region", "error", "tier = 'social'"),
    ("tickers must be non-empty strings", "error", "blank_ticker = 1"),
    ("no primary entity", "error", "n_entities = 0"), ("many key_numbers", "warning", "n_numbers > 6"),
    ("impact out of [0, 1]", "error", "impact > 1"), ("novelty out of [0, 1]", "error", "novelty > 1"),
    ("coverage must be positive", "error", "coverage < 1"), ("published_at is not a zoned timestamp", "error", "NOT zoned"),
    ("published outside the window", "error", "zoned AND NOT graced"), ("published in the grace period only", "warning", "graced AND NOT inside"),
    ("no sources", "error", "n_sources IS NULL"), ("Chinese source without original_title", "warning", "has_zh AND (id % 2 = 1 OR title = '')"),
    ("only social sources", "warning", "all_social"),
])


def item_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.item_violations(
        drafts(spark, sf), draft_sources(spark, sf), b.SETTINGS, TOPICS, ("primary", "press", "trade"), ("id", "issue_date")
    )


@query("v1_item_rules", f"SELECT item_id AS id, rule, severity FROM ({_ITEM_SQL})")
def item_rules(spark: SparkSession, sf: str) -> DataFrame:
    return item_violations(spark, sf).drop("issue_date")


@query("v1_source_rules", _rules_sql(
    "(SELECT *, url NOT LIKE 'https%' AS bad, CASE WHEN s_suppkey BETWEEN 1 AND 9 THEN ['primary', 'press', 'trade'][s_suppkey % 3 + 1] END AS known FROM draft_sources)",
    "doc_id, pos, part_key", [
        ("url is not http(s)", "error", "bad"), ("missing outlet", "error", "NOT bad AND outlet = ''"),
        ("unknown tier", "error", "NOT bad AND tier = 'blog'"), ("unknown lang", "error", "NOT bad AND lang = 'xx'"),
        ("tier differs from the known domain", "warning", "NOT bad AND known <> tier AND known <> 'primary' AND tier <> 'blog'"),
    ]))
def source_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.source_violations(draft_sources(spark, sf), KNOWN, keys=("doc_id", "pos", "part_key"))


@query("v7_report", f"""
SELECT CAST(issue_date AS VARCHAR) AS issue_date, count(*) FILTER (WHERE severity = 'error') AS errors, count(*) FILTER (WHERE severity = 'warning') AS warnings,
       count(*) FILTER (WHERE severity = 'error') = 0 AS ok FROM ({_ITEM_SQL}) GROUP BY issue_date
""")
def report(spark: SparkSession, sf: str) -> DataFrame:
    return day(quality.report(item_violations(spark, sf), "issue_date"))


# ---- types of what is written ----------------------------------------------------------------------
# --- fixed values: JSON of fields, right and wrong; None leaves the field out ---------------------
_TEXTS = ['"T"', '""', "12", "true", '{"a":1}', '["x"]', "null", "0.5", None, '"12"', '"kebab-case"']
_LISTS = ['["x","y"]', "[]", '["x",""]', '["x",5]', '["x",null]', '"x"', "null", None, '{"a":1}', '["x"]', "[1]"]
_NUMBERS = ["0.5", "1", "0", '"0.5"', "true", "1.5", "-1", "null", None, "2", "1.0", "1e-1"]
_SOURCES = ['[{"url":"https://a.example.org/x","outlet":"A"}]', "[]", '[5,{"url":"https://a.example.org/z"}]', '[{"url":5,"outlet":"A"}]', '[{"url":"https://a.example.org/y","outlet":7}]', '"x"', None, "null"]
_FIELDS = {
    "id": _TEXTS, "title": _TEXTS, "summary": _TEXTS, "why_it_matters": _TEXTS, "original_title": _TEXTS, "confidence_note": _TEXTS, "follow_up_of": _TEXTS,
    "published_at": _TEXTS, "entities": _LISTS, "key_numbers": _LISTS, "tickers": _LISTS, "impact": _NUMBERS, "novelty": _NUMBERS, "coverage": _NUMBERS, "sources": _SOURCES,
}


def _choice(k: int, n: int) -> str:
    """Which of n values the field number k of an item has: half of the items have the first, a right one."""
    return f"CASE WHEN (doc_id * {7 + 2 * k} + {k}) % 13 < 6 THEN 0 ELSE (doc_id * {3 + k} + doc_id // 5) % {n} END"


cte("written", "SELECT doc_id, CASE WHEN doc_id % 31 = 0 THEN '[1]' ELSE '{' || concat_ws(',', " + ", ".join(
    f"CASE WHEN {b.sql_list([v or '' for v in values])}[{_choice(k, len(values))} + 1] <> '' THEN '\"{name}\":' || {b.sql_list([v or '' for v in values])}[{_choice(k, len(values))} + 1] END"
    for k, (name, values) in enumerate(_FIELDS.items())
) + ") || '}' END::JSON AS j FROM documents")


def written_items(spark: SparkSession, sf: str) -> DataFrame:
    """An item as JSON for every document, with fields of all types, as a variant."""
    fields = []
    for k, (name, values) in enumerate(_FIELDS.items()):
        at = F.expr(_choice(k, len(values)).replace("doc_id // 5", "doc_id div 5"))
        value = F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))
        fields.append(F.when(value.isNotNull(), F.concat(F.lit(f'"{name}":'), value)))
    item = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    text = F.when(F.col("doc_id") % 31 == 0, "[1]").otherwise(item)
    return b.table(spark, sf, "documents").select("doc_id", F.parse_json(text).alias("value"))


def _type(field: str) -> str:
    return f"coalesce(json_type(j, '$.{field}'), 'NULL')"


def _gone(field: str) -> str:
    return f"({_type(field)} = 'NULL' OR (j ->> '$.{field}') = '' AND {_type(field)} = 'VARCHAR')"


_WHOLE = "('BIGINT', 'UBIGINT', 'HUGEINT')"
_TYPE_RULES = [("id must be a string", "error", f"{_type('id')} <> 'VARCHAR'")]
for _f in ("title", "summary", "why_it_matters"):
    _TYPE_RULES.append((f"missing {_f}", "error", _gone(_f)))
for _f in ("title", "summary", "why_it_matters", "original_title", "confidence_note", "follow_up_of"):
    _TYPE_RULES.append((f"{_f} must be a string", "error", f"NOT {_gone(_f)} AND {_type(_f)} <> 'VARCHAR'"))
for _f in ("entities", "key_numbers", "tickers"):
    _given = "true" if _f == "entities" else f"json_exists(j, '$.{_f}')"
    _all = f"{_type(_f)} = 'ARRAY' AND len(list_filter(TRY_CAST(j -> '$.{_f}' AS JSON[]), lambda x: x IS NULL OR json_type(x) <> 'VARCHAR' OR (x ->> '$') = '')) = 0"
    _TYPE_RULES.append((f"{_f} must be a list of non-empty strings", "error", f"{_given} AND NOT coalesce({_all}, false)"))
for _f in ("impact", "novelty"):
    _TYPE_RULES.append((f"{_f} must be a number in [0, 1]", "error", f"NOT coalesce({_type(_f)} IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND TRY_CAST(j ->> '$.{_f}' AS DOUBLE) BETWEEN 0 AND 1, false)"))
_TYPE_RULES += [
    ("coverage must be a positive integer", "error", f"NOT coalesce({_type('coverage')} IN {_WHOLE} AND TRY_CAST(j ->> '$.coverage' AS BIGINT) >= 1, false)"),
    ("published_at must be a string", "error", f"{_type('published_at')} <> 'VARCHAR'"),
    ("sources must be a non-empty list", "error", f"NOT coalesce({_type('sources')} = 'ARRAY' AND json_array_length(j, '$.sources') > 0, false)"),
]


@query("v1_item_types", f"""
SELECT doc_id, rule, severity FROM ({_rules_sql("(SELECT * FROM written WHERE json_type(j) = 'OBJECT')", "doc_id", _TYPE_RULES)})
UNION ALL SELECT doc_id, 'item must be an object', 'error' FROM written WHERE json_type(j) <> 'OBJECT'
""")
def item_types(spark: SparkSession, sf: str) -> DataFrame:
    """Types of the fields before anything is cast."""
    return types.item_type_violations(written_items(spark, sf), ["doc_id"])


@query("v1_source_types", f"""
WITH s AS (
  SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS BIGINT) AS pos, unnest(l) AS j
  FROM (SELECT doc_id, (j -> '$.sources')::JSON[] AS l FROM written WHERE json_type(j, '$.sources') = 'ARRAY')
)
SELECT doc_id, pos, rule, severity FROM ({_rules_sql("s", "doc_id, pos", [
    ("source must be an object", "error", "json_type(j) <> 'OBJECT'"), ("url must be a string", "error", f"json_type(j) = 'OBJECT' AND {_type('url')} <> 'VARCHAR'"),
    ("missing outlet", "error", f"json_type(j) = 'OBJECT' AND {_type('url')} = 'VARCHAR' AND {_gone('outlet')}"),
    ("outlet must be a string", "error", f"json_type(j) = 'OBJECT' AND {_type('url')} = 'VARCHAR' AND NOT {_gone('outlet')} AND {_type('outlet')} <> 'VARCHAR'"),
])})
""")
def source_types(spark: SparkSession, sf: str) -> DataFrame:
    items = written_items(spark, sf).withColumnRenamed("value", "doc")
    rows = documents.exploded(items, "sources", "doc_id")
    return types.source_type_violations(rows.withColumn("pos", F.col("pos").cast("bigint")), ["doc_id", "pos"])


# ---- upcoming events -----------------------------------------------------------------------------
cte("upcoming", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(o_orderdate AS DATE) AS seen_on, CAST(l_shipdate AS DATE) AS ship,
       CASE WHEN l_linenumber = 3 THEN strftime(l_shipdate, '%Y-%m') WHEN l_linenumber = 7 THEN strftime(l_shipdate, '%Y/%m') ELSE strftime(l_shipdate, '%Y-%m-%d') END AS date,
       CASE WHEN p_size = 13 THEN '' WHEN p_size > 45 THEN repeat(p_name || ' ' || p_type || ' ', 8) ELSE p_name || ' ' || p_type || ' ' || p_brand END AS title,
       CASE l_linestatus WHEN 'O' THEN 'launch' ELSE 'rumour' END AS kind, CASE l_returnflag WHEN 'A' THEN 'confirmed' WHEN 'R' THEN 'rumored' ELSE 'sure' END AS confidence,
       CASE l_suppkey % 3 WHEN 0 THEN 'https://a.example.com/' || l_partkey WHEN 1 THEN 'a.example.com/' || l_partkey END AS url
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
""")
EVENT_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def upcoming(spark: SparkSession, sf: str) -> DataFrame:
    n, p = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    rows = (
        b.table(spark, sf, "lineitem")
        .join(b.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(b.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    fmt = lambda f: F.date_format("l_shipdate", f)
    return rows.select(
        *EVENT_KEYS, F.to_date("o_orderdate").alias("seen_on"), F.to_date("o_orderdate").alias("today"),
        F.when(n == 3, fmt("yyyy-MM")).when(n == 7, fmt("yyyy/MM")).otherwise(fmt("yyyy-MM-dd")).alias("date"),
        F.when(F.col("p_size") == 13, "").when(F.col("p_size") > 45, F.repeat(F.concat("p_name", F.lit(" "), "p_type", F.lit(" ")), F.lit(8)))
        .otherwise(F.concat_ws(" ", "p_name", "p_type", "p_brand")).alias("title"),
        F.when(F.col("l_linestatus") == "O", "launch").otherwise("rumour").alias("kind"),
        F.when(F.col("l_returnflag") == "A", "confirmed").when(F.col("l_returnflag") == "R", "rumored").otherwise("sure").alias("confidence"),
        F.when(F.col("l_suppkey") % 3 == 0, F.concat(F.lit("https://a.example.com/"), p)).when(F.col("l_suppkey") % 3 == 1, F.concat(F.lit("a.example.com/"), p)).alias("url"),
    )


@query("v2_upcoming_rules", _rules_sql("upcoming", ", ".join(EVENT_KEYS), [
    ("date must be YYYY-MM-DD or YYYY-MM", "error", "l_linenumber = 7"),
    ("event is in the past", "warning", "l_linenumber NOT IN (3, 7) AND ship < seen_on - 1"),
    ("missing title", "error", "title = ''"), ("title is long", "warning", "length(title) > 110"), ("unknown kind", "error", "kind = 'rumour'"),
    ("unknown confidence", "error", "confidence = 'sure'"), ("url is not http(s)", "error", "url IS NOT NULL AND url NOT LIKE 'https%'"),
]))
def upcoming_rules(spark: SparkSession, sf: str) -> DataFrame:
    return quality.upcoming_violations(upcoming(spark, sf), EVENT_KEYS)


# ---- learn entries ---------------------------------------------------------------------------------
cte("entries", f"""
SELECT h.issue_date, CASE WHEN h.id % 13 = 0 THEN 'Lesson ' ELSE 'lesson-' END || h.id // 3 AS id, h.id AS doc_id,
       {b.sql_list([g.id for g in GAPS] + ['other'])}[h.id % 7 + 1] AS gap, title, text, h.id % 140 AS minutes,
       CASE WHEN h.id % 10 > 0 THEN [h.id, h.id + 5] ELSE [] END AS item_ids, h.id % 6 = 0 AS bad_ref
FROM headlines h JOIN labels ON doc_id = h.id
""")
_LEARN_SQL = _rules_sql("entries", "issue_date, id", [
    ("id is not kebab-case", "error", "id LIKE 'L%'"), ("unknown gap", "error", "gap = 'other'"), ("missing title", "error", "title = ''"),
    ("missing why_today", "error", "title = ''"), ("missing explanation", "error", "text = ''"), ("title is long", "warning", "length(title) > 90"),
    ("why_today is long", "warning", "length(title) > 320"), ("explanation is long", "warning", "length(text) > 1200"),
    ("no item_ids", "error", "len(item_ids) = 0"), ("minutes out of [1, 120]", "error", "minutes NOT BETWEEN 1 AND 120"),
    ("missing python", "error", "trim(text) = ''"), ("python is long", "warning", "trim(text) <> '' AND len(string_split(text, chr(10))) > 40"),
    ("ref without http(s) url", "error", "bad_ref"),
])


@query("v3_learn_rules", f"""
SELECT CAST(issue_date AS VARCHAR) AS issue_date, id, rule, severity, n FROM (
  SELECT issue_date, id, rule, severity, count(*) AS n FROM ({_LEARN_SQL}) GROUP BY ALL
  UNION ALL SELECT issue_date, id, 'duplicate id', 'error', count(*) - 1 FROM entries GROUP BY issue_date, id HAVING count(*) > 1
  UNION ALL SELECT issue_date, id, 'item_id is not in the issue', 'error', count(*) FROM (SELECT issue_date, id, unnest(item_ids) AS x FROM entries) e
    WHERE NOT EXISTS (SELECT 1 FROM headlines h WHERE h.id = e.x AND h.issue_date = e.issue_date) GROUP BY issue_date, id
  UNION ALL SELECT issue_date, NULL, 'too many entries', 'error', 1 FROM entries GROUP BY issue_date HAVING count(*) > 3)
""")
def learn_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.headlines(spark, sf)
    i = F.col("id")
    labelled = docs.join(b.table(spark, sf, "labels").select(F.col("doc_id").alias("id")), "id")
    entries = labelled.select(
        "issue_date", F.concat(F.when(i % 13 == 0, "Lesson ").otherwise("lesson-"), F.expr("id div 3").cast("string")).alias("id"),
        b.one_of(i, tuple(g.id for g in GAPS) + ("other",)).alias("gap"), "title", F.col("title").alias("why_today"), F.col("text").alias("explanation"),
        F.when(i % 10 > 0, F.array(i, i + 5)).otherwise(F.array().cast("array<bigint>")).alias("item_ids"), (i % 140).alias("minutes"),
        F.col("text").alias("python"),
        F.array(F.struct(F.when(i % 6 > 0, F.lit("https://example.com/ref")).alias("url"))).alias("refs"),
    )
    found = quality.learn_violations(entries, docs.select("issue_date", i.alias("item_id")), [g.id for g in GAPS])
    return day(found)


# ---- issues and weeklies ------------------------------------------------------------------------------
cte("issue_facts", """
SELECT day_date AS file_date, count(*) AS n_items, count(*) FILTER (WHERE id IN (SELECT l_orderkey FROM lineitem)) AS n_sourced,
       CASE WHEN day(day_date) = 1 THEN strftime(day_date, '%Y-%m') WHEN day(day_date) = 2 THEN strftime(day_date + 1, '%Y-%m-%d') ELSE strftime(day_date, '%Y-%m-%d') END AS date,
       CASE day(day_date) WHEN 3 THEN NULL ELSE (day(day_date) % 5) * 20 END AS hours, day(day_date) % 7 AS n_tldr
FROM all_items GROUP BY day_date
""")


@query("v4_issue_rules", f"SELECT CAST(file_date AS VARCHAR) AS file_date, rule, severity FROM (" + _rules_sql("issue_facts", "file_date", [
    ("date must be YYYY-MM-DD", "error", "day(file_date) = 1"), ("date does not match the file name", "error", "day(file_date) = 2"),
    ("window needs a start and an end", "error", "hours IS NULL"), ("window must start before it ends", "error", "hours <= 0"),
    ("window is too long", "error", "hours > 72"), ("tldr must be 1-4 strings", "error", "n_tldr NOT BETWEEN 1 AND 4"),
    ("no items", "error", "n_items < 1"), ("few items", "warning", "n_sourced BETWEEN 1 AND 7"),
]) + ")")
def issue_rules(spark: SparkSession, sf: str) -> DataFrame:
    sourced = b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id")).distinct().withColumn("has", F.lit(1))
    per_day = b.all_items(spark, sf, "day").join(sourced, "id", "left").groupBy(F.col("issue_date").alias("file_date")).agg(
        F.count(F.lit(1)).alias("n_items"), F.count("has").alias("n_sourced")
    )
    d = F.dayofmonth("file_date")
    start = F.col("file_date").cast("timestamp")
    issues = per_day.select(
        "*",
        F.when(d == 1, F.date_format("file_date", "yyyy-MM")).when(d == 2, b.day_text(F.date_add("file_date", 1))).otherwise(b.day_text(F.col("file_date"))).alias("date"),
        times.fmt_ts(start).alias("window_start"),
        F.when(d != 3, times.fmt_ts(start + F.make_dt_interval(hours=(d % 5) * 20))).alias("window_end"),
        F.array_repeat(F.lit("line"), (d % 7).cast("int")).alias("tldr"),
    )
    return day(quality.issue_violations(issues, b.SETTINGS), "file_date")


cte("weekly_facts", """
SELECT strftime(week_date, '%G-W%V') AS file_week, CASE WHEN count(*) % 5 = 0 THEN strftime(week_date + 7, '%G-W%V') ELSE strftime(week_date, '%G-W%V') END AS week,
       CASE WHEN count(*) % 7 = 0 THEN '' ELSE repeat('news ', CAST(count(*) AS INTEGER)) END AS headline, count(*) % 3 AS n_themes
FROM all_items GROUP BY week_date
""")


@query("v5_weekly_rules", _rules_sql("weekly_facts", "file_week", [
    ("week does not match the file name", "error", "week <> file_week"), ("missing headline", "error", "headline = ''"),
    ("headline is long", "warning", "length(headline) > 240"), ("no themes", "warning", "n_themes = 0"),
]))
def weekly_rules(spark: SparkSession, sf: str) -> DataFrame:
    per_week = b.all_items(spark, sf).groupBy("issue_date").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    weeklies = per_week.select(
        times.week_id(F.col("issue_date")).alias("file_week"),
        times.week_id(F.when(n % 5 == 0, F.date_add("issue_date", 7)).otherwise(F.col("issue_date"))).alias("week"),
        F.when(n % 7 == 0, "").otherwise(F.repeat(F.lit("news "), n.cast("int"))).alias("headline"), (n % 3).alias("n_themes"),
    )
    return quality.weekly_violations(weeklies)


@query("v5_theme_rules", _rules_sql("documents", "doc_id", [
    ("missing title", "error", "split_part(text, chr(10), 1) = ''"), ("missing summary", "error", "text = ''"),
    ("title is long", "warning", "length(split_part(text, chr(10), 1)) > 60"),
]))
def theme_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.headlines(spark, sf).select(F.col("id").alias("doc_id"), "title", F.col("text").alias("summary"))
    return quality.theme_violations(rows, ["doc_id"])
