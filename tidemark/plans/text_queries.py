"""Text, address and time expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, times, urls
from ..operators import scoring, views
from . import bindings as b
from .registry import query


@query("f1_canonical_url", "SELECT page_id, canonical FROM page_urls")
def canonical_url(spark: SparkSession, sf: str) -> DataFrame:
    return b.pages(spark, sf).select("page_id", urls.canonical_url(F.col("url")).alias("canonical"))


@query("f2_domain_of", "SELECT page_id, host FROM page_urls")
def domain_of(spark: SparkSession, sf: str) -> DataFrame:
    return b.pages(spark, sf).select("page_id", urls.domain_of(F.col("url")).alias("host"))


@query("f3_title_tokens", f"SELECT doc_id, {b.TITLE_WORDS_SQL.format('text')} AS tokens FROM documents")
def title_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "documents").select("doc_id", F.array_sort(text.title_tokens(F.col("text"))).alias("tokens"))


@query("f4_cluster_tokens", f"SELECT doc_id, {b.CLUSTER_WORDS_SQL.format('text')} AS tokens FROM documents")
def cluster_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "documents").select("doc_id", F.array_sort(text.cluster_tokens(F.col("text"))).alias("tokens"))


_NEXT_DOC = f"""
WITH tok AS (SELECT doc_id, {b.TITLE_WORDS_SQL.format('text')} AS t FROM documents)
SELECT a.doc_id, CAST(len(list_intersect(a.t, b.t)) AS INTEGER) AS shared,
       CAST(len(list_distinct(list_concat(a.t, b.t))) AS INTEGER) AS together,
       round(coalesce(len(list_intersect(a.t, b.t)) / CAST(nullif(len(list_distinct(list_concat(a.t, b.t))), 0) AS DOUBLE), 0), 6) AS jaccard
FROM tok a JOIN tok b ON b.doc_id = a.doc_id + 1
"""


@query("f5_jaccard", _NEXT_DOC.replace("CAST(len(list_intersect(a.t, b.t)) AS INTEGER) AS shared,\n", "").replace(
    "CAST(len(list_distinct(list_concat(a.t, b.t))) AS INTEGER) AS together,\n", ""))
def jaccard(spark: SparkSession, sf: str) -> DataFrame:
    """Each document against the next one."""
    return _neighbours(spark, sf).select("doc_id", F.round(text.jaccard(F.col("t"), F.col("u")), 6).alias("jaccard"))


def _neighbours(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.table(spark, sf, "documents").select("doc_id", text.title_tokens(F.col("text")).alias("t"))
    after = docs.select((F.col("doc_id") - 1).alias("doc_id"), F.col("t").alias("u"))
    return docs.join(after, "doc_id")


@query("u1_token_sets", _NEXT_DOC)
def token_sets(spark: SparkSession, sf: str) -> DataFrame:
    t, u = F.col("t"), F.col("u")
    return _neighbours(spark, sf).select(
        "doc_id",
        F.size(F.array_intersect(t, u)).alias("shared"),
        F.size(F.array_union(t, u)).alias("together"),
        F.round(text.jaccard(t, u), 6).alias("jaccard"),
    )


@query("u2_url_and_entity_overlap", """
SELECT a.item_id, count(DISTINCT CASE WHEN a.canonical = b.canonical THEN a.canonical END) AS shared_links, count(DISTINCT a.supp_key) AS shared_outlets
FROM sources a JOIN sources b ON b.item_id = a.item_id + 1 AND a.supp_key = b.supp_key GROUP BY a.item_id
""")
def overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Links and outlets that an item shares with the next one: set intersection as an equi-join of
    distinct elements, so no item's set is collected."""
    rows = b.sources(spark, sf).select("item_id", "supp_key", urls.canonical_url(F.col("url")).alias("link")).distinct()
    after = rows.select((F.col("item_id") - 1).alias("item_id"), "supp_key", F.col("link").alias("next_link"))
    met = rows.join(after, ["item_id", "supp_key"])
    return met.groupBy("item_id", "supp_key").agg(
        F.count_if(F.col("link") == F.col("next_link")).alias("links")
    ).groupBy("item_id").agg(F.sum("links").alias("shared_links"), F.count(F.lit(1)).alias("shared_outlets"))


@query("f8_clean_text", """
SELECT page_id, CASE WHEN length(t) <= 600 THEN t ELSE rtrim(substr(t, 1, 599)) || '…' END AS summary
FROM (SELECT page_id, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
      '&quot;', '"'), '&middot;', '·'), '&copy;', '©'), '&amp;', '&'), '\\s+', ' ', 'g')) AS t FROM pages)
""")
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return b.pages(spark, sf).select("page_id", text.clean_text(F.col("html"), 600).alias("summary"))


@query("f9_parse_date", """
SELECT id, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS rfc822, strftime(published_at - INTERVAL 8 HOUR, '%Y-%m-%dT%H:%M:%SZ') AS iso,
       strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS naive, CAST(NULL AS VARCHAR) AS bad
FROM headlines
""")
def parse_date(spark: SparkSession, sf: str) -> DataFrame:
    """Dates written the way feeds write them, parsed back."""
    ts = F.col("published_at")
    written = {
        "rfc822": F.concat(F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")),
        "iso": F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00")),
        "naive": F.date_format(ts, "d MMM yyyy HH:mm:ss"),
        "bad": F.concat(F.lit("on "), F.date_format(ts, "yyyy/MM/dd")),
    }
    return b.headlines(spark, sf).select(
        "id", *[times.fmt_ts(times.parse_feed_date(v)).alias(k) for k, v in written.items()]
    )


@query("f10_timestamps", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d') AS local_day FROM events
""")
def timestamps(spark: SparkSession, sf: str) -> DataFrame:
    parsed = times.parse_ts(times.fmt_ts(F.col("ts")))
    return b.table(spark, sf, "events").select(
        "event_id", times.fmt_ts(parsed).alias("stamp"), b.day_text(times.local_date(parsed)).alias("local_day")
    )


@query("f11_iso_week", """
SELECT id, strftime(published_at, '%G-W%V') AS week, CAST(week_date AS VARCHAR) AS monday, CAST(week_date + 6 AS VARCHAR) AS sunday
FROM all_items
""")
def iso_week(spark: SparkSession, sf: str) -> DataFrame:
    week = times.week_id(F.to_date("published_at"))
    monday, sunday = times.week_bounds(week)
    return b.all_items(spark, sf).select(
        "id", week.alias("week"), b.day_text(monday).alias("monday"), b.day_text(sunday).alias("sunday")
    )


@query("f12_date_range", """
SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(sum(k) AS BIGINT) AS n
FROM (SELECT k, unnest(generate_series(first, last, INTERVAL 1 DAY)) AS ts
      FROM (SELECT CAST(o_orderdate AS DATE) AS first, CAST(l_shipdate AS DATE) AS last, count(*) AS k
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL))
GROUP BY ALL
""")
def date_range(spark: SparkSession, sf: str) -> DataFrame:
    """Lines open on each day, from order to shipment."""
    first, last = F.to_date("o_orderdate").alias("first"), F.to_date("l_shipdate").alias("last")
    lines = b.table(spark, sf, "lineitem").join(b.table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    open_lines = views.open_per_day(lines.select(first, last), "first", "last")
    return open_lines.select(b.day_text(F.col("day")).alias("day"), "n")


@query("f15_url_id", "SELECT page_id, substr(sha1(canonical), 1, 12) AS url_id FROM page_urls")
def url_id(spark: SparkSession, sf: str) -> DataFrame:
    return b.pages(spark, sf).select("page_id", urls.url_id(F.col("url")).alias("url_id"))


@query("f16_first_sentence", """
SELECT doc_id, CASE WHEN regexp_matches(t, '[.!?] ["''“(A-Z0-9]')
       THEN regexp_extract(t, '^(.*?[.!?]) ["''“(A-Z0-9]', 1) ELSE t END AS sentence
FROM (SELECT doc_id, regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '^ | $', '', 'g') AS t FROM documents)
""")
def first_sentence(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "documents").select("doc_id", text.first_sentence(F.col("text")).alias("sentence"))


KNOWN_DOMAINS = {
    "example.com": ("Example", "press"),
    "tionsh.example.net": ("Tionsh", "primary"),
    "example.net": ("Net", "trade"),
    "blog.theres.example.com": ("Theres blog", "social"),
}


@query("j5_known_domain", """
SELECT page_id, host, CASE WHEN host = 'blog.theres.example.com' THEN 'social'
  WHEN host = 'tionsh.example.net' OR host LIKE '%.tionsh.example.net' THEN 'primary'
  WHEN host = 'example.net' OR host LIKE '%.example.net' THEN 'trade'
  WHEN host = 'example.com' OR host LIKE '%.example.com' THEN 'press' END AS known_tier
FROM page_urls
""")
def known_domain(spark: SparkSession, sf: str) -> DataFrame:
    known = urls.with_known_domain(b.pages(spark, sf), "url", KNOWN_DOMAINS)
    return known.select("page_id", urls.domain_of(F.col("url")).alias("host"), "known_tier")


@query("j6_alias", """
SELECT s_suppkey, CASE n_name WHEN 'NATION_20' THEN 'NATION_0' WHEN 'NATION_21' THEN 'NATION_1' ELSE n_name END AS entity
FROM supplier JOIN nation ON s_nationkey = n_nationkey
""")
def alias(spark: SparkSession, sf: str) -> DataFrame:
    spelled = F.concat(F.lit(" "), F.initcap("n_name"), F.lit(" "))
    name = F.when(F.lower("n_name").isin([a.lower() for a in b.SETTINGS.aliases]), spelled).otherwise(F.col("n_name"))
    supp, nation = b.table(spark, sf, "supplier"), b.table(spark, sf, "nation")
    return supp.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", scoring.canonical_entity(name, b.SETTINGS.aliases).alias("entity")
    )
