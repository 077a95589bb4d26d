"""Scans and sinks, payload ingest, calendar, marts and the rebuild check."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import feed_dimension
from ..functions import text, times
from ..operators import calendar, harvest, learn, market, marts, placement, views
from ..operators.ranking import rank_in_group
from ..session import cut, once, stored, work_path
from ..sources import archive, documents, payloads, prices as price_store, snapshots
from . import bindings as b
from .dedupe_queries import CLEAN_SQL, KNOWN_OUTLETS, TOPICAL_SQL
from .learn_queries import GAPS
from .market_queries import prices, study
from .quality_queries import upcoming
from .registry import cte, query
from .view_queries import _T, day, entities, placed_days, sourced, topic_columns, topic_sql


# ---- archive documents -------------------------------------------------------------------
def _item_json() -> Column:
    return F.to_json(F.struct(
        F.concat(F.lit("order-"), F.col("id").cast("string")).alias("id"), F.col("topic"), F.col("region"),
        F.array("entity").alias("entities"), "coverage", "impact", "novelty", times.fmt_ts(F.col("published_at")).alias("published_at"),
    ))


def daily_files(spark: SparkSession, sf: str) -> str:
    """Every week of orders as one document in a file named by its Monday, and files that are no issues beside them."""
    path = work_path(spark, "daily")
    name, day_of = F.concat(b.day_text(F.col("issue_date")), F.lit(".json")), b.day_text(F.col("issue_date"))
    window = F.to_json(F.struct(
        times.fmt_ts(F.col("issue_date").cast("timestamp")).alias("start"), times.fmt_ts(F.date_add("issue_date", 7).cast("timestamp")).alias("end")
    ))
    head = F.concat(F.lit('{"date":"'), day_of, F.lit('","window":'), window, F.lit(',"tldr":["one"],"items":['))
    rows = b.all_items(spark, sf).select(name.alias("name"), head.alias("head"), _item_json().alias("item"), F.lit("]}").alias("tail"), "id")
    drafts = rows.filter(F.col("id") % 50 == 0).withColumn("name", F.concat(F.lit("draft-"), "name"))
    documents.write_documents(rows.unionByName(drafts), path, [F.col("id")])
    return path


@query("s1_daily_scan", """
SELECT CAST(week_date AS VARCHAR) AS issue_date, 'order-' || id AS id, topic, entity, CAST(coverage AS INTEGER) AS coverage, round(impact, 8) AS impact
FROM all_items WHERE week_date BETWEEN DATE '1995-03-01' AND DATE '2001-07-01'
""")
def daily_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Scan a date range of issue files by their names with the declared schema; other files in the folder are ignored."""
    docs = archive.read_daily(spark, daily_files(spark, sf), "1995-03-01", "2001-07-01")
    return archive.issue_items(docs).select(
        b.day_text(F.col("issue_date")).alias("issue_date"), "id", "topic", F.get("entities", F.lit(0)).alias("entity"), "coverage",
        F.round("impact", 8).alias("impact"),
    )


@query("s1_variant_scan", """
SELECT CAST(week_date AS VARCHAR) AS issue_date, 'order-' || id AS id, row_number() OVER (PARTITION BY week_date ORDER BY id) - 1 AS pos, topic, CAST(coverage AS INTEGER) AS coverage
FROM all_items
""")
def variant_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The same files without a schema: each a variant, its items exploded with their place."""
    docs = documents.read_documents(spark, daily_files(spark, sf), archive.DAILY_NAME)
    rows = documents.exploded(docs, "items", "name")
    found = documents.typed(rows, "struct<id:string,topic:string,coverage:int>", "name", "pos")
    return found.select(F.col("name").alias("issue_date"), "id", F.col("pos").cast("bigint").alias("pos"), "topic", "coverage")


def weekly_files(spark: SparkSession, sf: str) -> str:
    """All orders as the items of their ISO week, a file a week."""
    path = work_path(spark, "weekly")
    week = times.week_id(F.col("issue_date"))
    head = F.concat(F.lit('{"week":"'), week, F.lit('","headline":"Week '), week, F.lit('","items":['))
    rows = b.all_items(spark, sf).select(F.concat(week, F.lit(".json")).alias("name"), head.alias("head"), _item_json().alias("item"), F.lit("]}").alias("tail"), "id")
    documents.write_documents(rows, path, [F.col("id")])
    return path


@query("s2_weekly_scan", """
SELECT strftime(week_date, '%G-W%V') AS week, 'order-' || id AS id, topic FROM all_items
""")
def weekly_scan(spark: SparkSession, sf: str) -> DataFrame:
    return archive.weekly_items(archive.read_weekly(spark, weekly_files(spark, sf))).select("week", "id", "topic")


cte("daily_rows", "SELECT id, topic, published_at, day_date AS issue_date FROM all_items WHERE topic <> '5-LOW'")
cte("backfill_rows", """
SELECT id, topic, published_at, strftime(published_at, '%G-W%V') AS week, CAST(published_at + INTERVAL 8 HOUR AS DATE) AS issue_date
FROM all_items WHERE topic IN ('5-LOW', '1-URGENT')
""")
_RANGE = ("1995-02-01", "2001-07-15")
cte("between_rows", f"""
SELECT id, topic, issue_date FROM daily_rows WHERE issue_date BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}'
UNION ALL
SELECT id, topic, issue_date FROM backfill_rows WHERE issue_date BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}'
  AND id NOT IN (SELECT id FROM daily_rows WHERE issue_date BETWEEN DATE '{_RANGE[0]}' AND DATE '{_RANGE[1]}')
""")


def daily_and_weekly(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    items = b.all_items(spark, sf, "day").select("id", "topic", "published_at", "issue_date")
    weekly = items.filter(F.col("topic").isin("5-LOW", "1-URGENT")).withColumn("week", times.week_id(F.col("issue_date"))).drop("issue_date")
    return items.filter("topic <> '5-LOW'"), weekly


@query("s3_items_between", "SELECT id, topic, CAST(issue_date AS VARCHAR) AS issue_date FROM between_rows")
def items_between(spark: SparkSession, sf: str) -> DataFrame:
    start, end = (F.lit(d).cast("date") for d in _RANGE)
    rows = archive.items_between(*daily_and_weekly(spark, sf), start, end)
    return day(rows.select("id", "topic", "issue_date"))


@query("j12_backfill_anti_join", """
SELECT id, topic FROM backfill_rows WHERE id NOT IN (SELECT id FROM daily_rows)
""")
def backfill_anti_join(spark: SparkSession, sf: str) -> DataFrame:
    daily, weekly = daily_and_weekly(spark, sf)
    return weekly.join(daily.select("id"), "id", "left_anti").select("id", "topic")


@query("u3_daily_weekly_union", """
SELECT kind, topic, count(*) AS n FROM (SELECT 'daily' AS kind, topic FROM daily_rows UNION ALL SELECT 'weekly', topic FROM backfill_rows) GROUP BY ALL
""")
def daily_weekly_union(spark: SparkSession, sf: str) -> DataFrame:
    daily, weekly = daily_and_weekly(spark, sf)
    both = daily.withColumn("kind", F.lit("daily")).unionByName(weekly.withColumn("kind", F.lit("weekly")), allowMissingColumns=True)
    return both.groupBy("kind", "topic").agg(F.count(F.lit(1)).alias("n"))


# ---- price store -----------------------------------------------------------------------------
_SIG = "round(close * pow(10, 5 - floor(log10(close)))) / pow(10, 5 - floor(log10(close)))"


@query("s4_price_scan", f"""
SELECT symbol, CAST(date AS VARCHAR) AS date, round(CASE WHEN date >= DATE '1998-01-01' THEN {_SIG} ELSE {_SIG.replace("close", f"(2 * ({_SIG}))")} END, 3) AS close FROM prices
""")
def price_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of the store as CSV, scanned together; the later one wins where both have a session."""
    rows = cut(prices(spark, sf))
    root = work_path(spark, "prices")
    price_store.write_prices(rows, f"{root}/load-1")
    restated = rows.filter("date < DATE'1998-01-01'").select("symbol", "date", market.significant(F.col("close")).alias("close"))
    price_store.write_prices(restated.withColumn("close", F.col("close") * 2), f"{root}/load-2")
    return price_store.read_prices(spark, f"{root}/load-*").select("symbol", b.day_text(F.col("date")).alias("date"), F.round("close", 3).alias("close"))


@query("s5_price_sink", f"SELECT symbol, CAST(date AS VARCHAR) AS date, round({_SIG}, 3) AS close FROM prices")
def price_sink(spark: SparkSession, sf: str) -> DataFrame:
    path = work_path(spark, "prices")
    price_store.write_prices(prices(spark, sf), path)
    return price_store.read_prices(spark, path).select("symbol", b.day_text(F.col("date")).alias("date"), F.round("close", 3).alias("close"))


# ---- snapshots ----------------------------------------------------------------------------------
def _snapshots(spark: SparkSession, sf: str) -> str:
    path = work_path(spark, "raw")
    rows = b.headlines(spark, sf).select("id", "title", "outlet", "published_at")
    snapshots.write_snapshot(rows, path, F.col("published_at"))
    return path


@query("s6_snapshot_latest", """
SELECT CAST(d AS VARCHAR) AS harvest_date, id, title FROM (SELECT id, title, CAST(published_at + INTERVAL 8 HOUR AS DATE) AS d FROM headlines) QUALIFY d = max(d) OVER ()
""")
def snapshot_latest(spark: SparkSession, sf: str) -> DataFrame:
    return day(snapshots.latest_snapshot(spark, _snapshots(spark, sf)).select("harvest_date", "id", "title"), "harvest_date")


@query("s7_retention", """
SELECT CAST(d AS VARCHAR) AS harvest_date, count(*) AS n FROM (SELECT CAST(published_at + INTERVAL 8 HOUR AS DATE) AS d FROM headlines)
WHERE d >= (SELECT max(CAST(published_at + INTERVAL 8 HOUR AS DATE)) FROM headlines) - 30 GROUP BY d
""")
def retention(spark: SparkSession, sf: str) -> DataFrame:
    rows = snapshots.read_snapshots(spark, _snapshots(spark, sf))
    today = F.lit(rows.agg(F.max("harvest_date")).first()[0])
    kept = snapshots.retained(rows, today, b.SETTINGS.retention_days)
    return day(kept.groupBy("harvest_date").agg(F.count(F.lit(1)).alias("n")), "harvest_date")


FEEDS = [
    {"name": f"src{i}", "kind": ("rss", "gnews")[i % 2], "tier": ("primary", "press", "trade")[i % 3], "filter": i % 4 == 0, "enabled": i % 5 > 0}
    for i in range(20)
]


@query("s7_prune", """
SELECT CAST(d AS VARCHAR) AS harvest_date, count(*) AS n FROM (SELECT CAST(published_at + INTERVAL 8 HOUR AS DATE) AS d FROM headlines)
WHERE d >= (SELECT max(CAST(published_at + INTERVAL 8 HOUR AS DATE)) FROM headlines) - 30 GROUP BY d
""")
def prune_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """A table of snapshots in the catalog, pruned: the older partitions are gone from storage."""
    name = f"snapshots_{uuid.uuid4().hex}"
    snapshots.create_snapshot_table(spark, name, "id BIGINT, title STRING, outlet STRING, published_at TIMESTAMP")
    rows = b.headlines(spark, sf).select("id", "title", "outlet", F.col("published_at").cast("timestamp").alias("published_at"))
    snapshots.append_snapshot(rows, name, F.col("published_at"))
    snapshots.prune(spark, name, keep_days=b.SETTINGS.retention_days)
    return day(spark.table(name).groupBy("harvest_date").agg(F.count("*").alias("n")), "harvest_date")


@query("s8_dimensions", """
SELECT outlet AS feed, ['primary', 'press', 'trade'][n % 3 + 1] AS tier, ['rss', 'gnews'][n % 2 + 1] AS kind, count(*) AS n
FROM (SELECT outlet, CAST(substr(outlet, 4) AS INTEGER) AS n FROM headlines) WHERE n % 5 > 0 AND n < 20 GROUP BY ALL
""")
def dimensions(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of enabled feeds with the feed's tier and kind."""
    feeds = feed_dimension(spark, FEEDS).select("feed", "tier", "kind")
    rows = b.headlines(spark, sf).select(F.col("outlet").alias("feed"))
    return rows.join(F.broadcast(feeds), "feed").groupBy("feed", "tier", "kind").agg(F.count(F.lit(1)).alias("n"))


# ---- payloads --------------------------------------------------------------------------------------
def _xml_text(c) -> object:
    for raw, ref in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(raw), F.lit(ref))
    return c


def payload_pages(spark: SparkSession, sf: str, broken: bool = False) -> DataFrame:
    """Documents as fetched pages, one document to a page, in the five notations by id: RSS 2.0, RSS 1.0,
    Atom, papers and stories. `broken` adds a control character, a bare ampersand and an HTML entity."""
    i = F.col("id")
    title, body = _xml_text(F.col("title")), _xml_text(F.col("text"))
    if broken:
        title = F.concat(F.lit("AT&T &nbsp;\x07"), title)
    link = F.concat(F.lit("http://www.example.com/"), i.cast("string"), F.lit("?utm_source=x"))
    ts = F.col("published_at")
    rss2 = F.concat(
        F.lit('<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>c</title><item><title>'), title,
        F.lit("</title><link>"), link, F.lit("</link><pubDate>"), F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate><description>"), body,
        F.lit('</description><source url="https://'), "outlet", F.lit('.example.net">'), "outlet", F.lit("</source></item></channel></rss>"),
    )
    rss1 = F.concat(
        F.lit('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">'
              "<channel><title>c</title></channel><item><title>"), title, F.lit("</title><link>"), link, F.lit("</link><dc:date>"),
        times.fmt_ts(ts), F.lit("</dc:date><description>"), body, F.lit("</description></item></rdf:RDF>"),
    )
    atom = F.concat(
        F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>c</title><entry><title>'), title, F.lit('</title><link rel="self" href="http://self"/><link href="'),
        link, F.lit('"/><updated>'), times.fmt_ts(ts), F.lit("</updated><content>"), body, F.lit("</content></entry></feed>"),
    )
    paper = F.to_json(F.array(F.struct(
        F.struct(i.cast("string").alias("id"), F.col("title").alias("title"), F.col("text").alias("summary"), F.col("n_chars").alias("upvotes")).alias("paper"),
        times.fmt_ts(ts).alias("publishedAt"),
    )))
    story = F.to_json(F.struct(F.array(F.struct(
        i.cast("string").alias("objectID"), F.col("title").alias("title"), F.when(i % 2 == 0, link).alias("url"),
        F.unix_seconds(ts.cast("timestamp")).alias("created_at_i"), F.col("n_chars").alias("points"), F.lit(None).cast("bigint").alias("num_comments"),
    )).alias("hits")))
    kind = b.one_of(i, ("rss", "gnews", "rss", "hf", "hn"))
    page = F.when(i % 5 == 0, rss2).when(i % 5 == 1, rss1).when(i % 5 == 2, atom).when(i % 5 == 3, paper).otherwise(story)
    return b.headlines(spark, sf).select(
        F.col("outlet").alias("feed"), kind.alias("kind"), i.alias("url_pos"), page.alias("payload"), "tier", "lang"
    )


_PLAIN = "regexp_replace(regexp_replace({0}, '^[\\s]+|[\\s]+$', '', 'g'), '\\r\\n?', chr(10), 'g')"


def _compact(rows: DataFrame) -> DataFrame:
    """Texts by their length and hash, blanks at the ends aside."""
    clean = F.regexp_replace(F.regexp_replace("summary", r"^\s+|\s+$", ""), r"\r\n?", "\n")
    return rows.select("url_pos", F.trim("title").alias("title"), "url", "published", F.length(clean).alias("n_summary"), F.md5(clean).alias("summary"), "outlet")


_FEED_SQL = f"""
SELECT id AS url_pos, {{title}} AS title, 'http://www.example.com/' || id || '?utm_source=x' AS url,
       CASE WHEN id % 5 = 0 THEN strftime(published_at, '%a, %d %b %Y %H:%M:%S GMT') ELSE strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') END AS published,
       CAST(length({_PLAIN.format('text')}) AS INTEGER) AS n_summary, md5({_PLAIN.format('text')}) AS summary, CASE WHEN id % 5 = 0 THEN outlet ELSE '' END AS outlet
FROM headlines WHERE id % 5 < 3 AND trim({{title}}) <> ''
"""


@query("s9_feed_ingest", _FEED_SQL.format(title="trim(title)"))
def feed_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Every page in its notation; the XML ones come out here, the JSON ones in s10 and s11."""
    pages = payload_pages(spark, sf).filter(F.col("kind").isin("rss", "gnews"))
    return _compact(payloads.feed_rows(payloads.parse_feed(pages)))


@query("s12_payload_repair", _FEED_SQL.format(title="trim('AT&T ' || chr(160) || title)"))
def payload_repair(spark: SparkSession, sf: str) -> DataFrame:
    pages = payload_pages(spark, sf, broken=True).filter(F.col("kind").isin("rss", "gnews"))
    return _compact(payloads.feed_rows(payloads.parse_feed(pages)))


@query("s10_paper_ingest", """
SELECT id AS url_pos, trim(title) AS title, 'https://arxiv.org/abs/' || id AS url, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published, md5(text) AS summary, n_chars AS hf_upvotes
FROM headlines WHERE id % 5 = 3 AND trim(title) <> ''
""")
def paper_ingest(spark: SparkSession, sf: str) -> DataFrame:
    rows = payloads.feed_rows(payloads.parse_papers(payload_pages(spark, sf).filter("kind = 'hf'")))
    return rows.select("url_pos", "title", "url", "published", F.md5("summary").alias("summary"), "signals.hf_upvotes")


@query("s11_story_ingest", """
SELECT id AS url_pos, trim(title) AS title, CASE WHEN id % 2 = 0 THEN 'http://www.example.com/' || id || '?utm_source=x' ELSE 'https://news.ycombinator.com/item?id=' || id END AS url,
       strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published, n_chars AS hn_points, CAST(0 AS BIGINT) AS hn_comments, 'https://news.ycombinator.com/item?id=' || id AS hn_url
FROM headlines WHERE id % 5 = 4 AND trim(title) <> ''
""")
def story_ingest(spark: SparkSession, sf: str) -> DataFrame:
    rows = payloads.feed_rows(payloads.parse_stories(payload_pages(spark, sf).filter("kind = 'hn'")))
    return rows.select("url_pos", "title", "url", "published", "signals.hn_points", "signals.hn_comments", "signals.hn_url")


@query("harvest_end_to_end", f"""
WITH c AS (SELECT *, id % 5 AS k, {CLEAN_SQL.format('title')} AS t, CASE WHEN id % 5 = 4 THEN '' ELSE {CLEAN_SQL.format('text')} END AS s FROM headlines WHERE trim(title) <> ''),
d AS (SELECT *, CASE WHEN length(t) <= 300 THEN t ELSE rtrim(substr(t, 1, 299)) || '…' END AS clean_title,
             CASE WHEN length(s) <= 600 THEN s ELSE rtrim(substr(s, 1, 599)) || '…' END AS summary FROM c)
SELECT substr(sha1(CASE WHEN k = 3 THEN 'https://arxiv.org/abs/' || id WHEN k = 4 AND id % 2 = 1 THEN 'https://news.ycombinator.com/item?id=' || id ELSE 'https://example.com/' || id END), 1, 12) AS id,
       clean_title AS title,
       CASE WHEN k = 3 THEN 'https://arxiv.org/abs/' || id WHEN k = 4 AND id % 2 = 1 THEN 'https://news.ycombinator.com/item?id=' || id ELSE 'http://www.example.com/' || id || '?utm_source=x' END AS url,
       CASE WHEN k = 3 THEN 'Hugging Face Daily Papers' WHEN k = 4 THEN 'Hacker News' WHEN k > 0 AND id % 2 = 0 THEN 'mirror' ELSE outlet END AS outlet,
       tier, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_at
FROM d WHERE lang <> 'de' OR {TOPICAL_SQL.format("clean_title || ' ' || summary")}
""")
def harvest_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of all notations to merged items: parse, filter German ones by topic, normalise, merge by id. Every second page
    is also fetched by a mirror that comes first in the order of feeds."""
    pages = payload_pages(spark, sf).withColumn("feed_pos", F.lit(1))
    mirrored = pages.filter(F.col("url_pos") % 2 == 0).withColumns({"feed": F.lit("mirror"), "feed_pos": F.lit(0)})
    rows = payloads.feed_rows(payloads.parse_pages(pages.unionByName(mirrored)))
    place = F.shiftleft(F.col("url_pos"), 24) + F.col("row_pos")  # a page is one string and holds fewer entries than 2^24
    dated = once(rows, "published_at", times.parse_feed_date(F.col("published"))).filter("published_at is not null").withColumns({
        "filter": F.col("lang") == "de", "row_pos": place + F.shiftleft(F.col("feed_pos").cast("bigint"), 61),
    })
    items = harvest.normalise(dated, KNOWN_OUTLETS, b.SETTINGS)
    merged = harvest.merge_by_id(stored(items, "harvested"), "row_pos")
    return merged.select("id", "title", "url", "outlet", "tier", times.fmt_ts(F.col("published_at")).alias("published_at"))


# ---- calendar ---------------------------------------------------------------------------------------
AS_OF = "1998-06-15"
_WIDE = replace(b.SETTINGS, calendar_lookback_days=10_000, calendar_horizon_days=10_000)


def _announcements(spark: SparkSession, sf: str) -> DataFrame:
    """Part shipments as announced events; the place in the announcement is the line's keys in order."""
    return upcoming(spark, sf).withColumn("pos", F.struct("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey"))


cte("announced_events", f"""
SELECT seen_on, date, title, (l_orderkey, l_partkey, l_linenumber, l_suppkey) AS pos, {b.TITLE_WORDS_SQL.format('title')} AS tokens
FROM upcoming WHERE seen_on <= DATE '{AS_OF}'
""")
cte("event_titles", "SELECT DISTINCT date, tokens, array_to_string(tokens, ' ') AS k FROM announced_events")
cte("event_links", """
SELECT a.date, a.k AS x, b.k AS y FROM event_titles a JOIN event_titles b ON a.date = b.date AND a.k <> b.k
WHERE len(list_intersect(a.tokens, b.tokens)) / CAST(len(a.tokens) + len(b.tokens) - len(list_intersect(a.tokens, b.tokens)) AS DOUBLE) >= 0.6
""")
cte("event_reach", """
SELECT date, k, k AS label FROM event_titles
UNION
SELECT l.date, l.y, r.label FROM event_reach r JOIN event_links l ON l.date = r.date AND l.x = r.k WHERE r.label < l.y
""")


@query("w11_calendar_components", f"""
WITH c AS (SELECT date, k, min(label) AS component FROM event_reach GROUP BY date, k),
g AS (SELECT a.*, CASE WHEN len(tokens) = 0 THEN 'none ' || CAST(pos AS VARCHAR) ELSE component END AS grp FROM announced_events a JOIN c ON c.date = a.date AND c.k = array_to_string(a.tokens, ' '))
SELECT date, last(title ORDER BY seen_on, pos) AS title, CAST(min(seen_on) AS VARCHAR) AS first_seen
FROM g WHERE CASE WHEN length(date) = 10 THEN date ELSE date || '-32' END >= '{AS_OF}' GROUP BY date, grp
""")
def calendar_components(spark: SparkSession, sf: str) -> DataFrame:
    rows = calendar.calendar_by_component(_announcements(spark, sf), F.lit(AS_OF).cast("date"), _WIDE)
    return day(rows.select("date", "title", "first_seen"), "first_seen")


@query("w11_calendar_fold")
def calendar_fold(spark: SparkSession, sf: str) -> DataFrame:
    """The order-dependent merge; SQL cannot fold it, tests compare it with a plain loop."""
    return day(calendar.calendar(_announcements(spark, sf), F.lit(AS_OF).cast("date"), _WIDE), "first_seen")


cte("all_announcements", f"""
SELECT CASE WHEN l_suppkey % 5 = 0 THEN CAST(date_trunc('week', seen_on) AS DATE) + 6 ELSE seen_on END AS seen_on,
       (CASE WHEN l_suppkey % 5 = 0 THEN 1 ELSE 0 END, CASE WHEN l_suppkey % 5 = 0 THEN strftime(seen_on, '%G-W%V') ELSE '' END,
        l_orderkey, l_partkey, l_linenumber, l_suppkey) AS pos, date, title, kind, confidence, url, {b.TITLE_WORDS_SQL.format('title')} AS tokens
FROM upcoming
""")
_SAME = "len(list_intersect(s.tokens, x[1].tokens)) >= 0.6 * len(list_distinct(list_concat(s.tokens, x[1].tokens))) AND len(s.tokens) + len(x[1].tokens) > 0"


cte("calendar_shown", """
  SELECT as_of, a.* FROM (SELECT DISTINCT seen_on AS as_of FROM upcoming) JOIN all_announcements a ON a.seen_on BETWEEN as_of - 30 AND as_of
  WHERE CASE WHEN length(date) = 10 THEN date ELSE date || '-32' END >= strftime(as_of, '%Y-%m-%d') AND substr(date, 1, 10) <= strftime(as_of + 60, '%Y-%m-%d')
""")
cte("calendar_slots", f"""
  SELECT as_of, date, list_reduce(
    list([struct_pack(tokens := tokens, title := title, kind := kind, confidence := confidence, url := url, first_seen := seen_on)] ORDER BY seen_on, pos),
    lambda acc, x: list_transform([coalesce(list_position(list_transform(acc, lambda s: {_SAME}), true), 0)], lambda p: list_concat(
      list_transform(range(1, len(acc) + 1), lambda i: CASE WHEN i = p THEN struct_pack(tokens := x[1].tokens, title := x[1].title, kind := x[1].kind,
        confidence := x[1].confidence, url := x[1].url, first_seen := acc[i].first_seen) ELSE acc[i] END),
      CASE WHEN p = 0 THEN x ELSE x[2:] END))[1]
  ) AS folded FROM calendar_shown GROUP BY as_of, date
""")
cte("calendar_rows", "SELECT as_of, date, unnest(folded) AS e FROM calendar_slots")


@query("w11_calendar_all_days", """
SELECT CAST(as_of AS VARCHAR) AS as_of, date, e.title AS title, e.kind AS kind, e.confidence AS confidence, e.url AS url, CAST(e.first_seen AS VARCHAR) AS first_seen FROM calendar_rows
""")
def calendar_all_days(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar of every issue date, with the look-back and horizon of the settings; every fifth supplier's
    announcements come from weeklies."""
    daily, weekly = calendar_sources(spark, sf)
    days = upcoming(spark, sf).select(F.col("seen_on").alias("as_of")).distinct()
    rows = calendar.calendar_days(calendar.daily_and_weekly(daily, weekly), days, b.SETTINGS)
    return day(rows, "as_of", "first_seen")


def calendar_sources(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Upcoming events of dailies and of weeklies."""
    rows = _announcements(spark, sf)
    from_weekly = F.col("l_suppkey") % 5 == 0
    daily = rows.filter(~from_weekly).withColumn("issue_date", F.col("seen_on"))
    return daily, rows.filter(from_weekly).withColumn("week", times.week_id(F.col("seen_on")))


@query("p9_calendar_horizon", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN length(date) = 10 THEN date ELSE date || '-32' END >= strftime(seen_on, '%Y-%m-%d')
       AND substr(date, 1, 10) <= strftime(seen_on + 60, '%Y-%m-%d') AS ahead FROM upcoming
""")
def calendar_horizon(spark: SparkSession, sf: str) -> DataFrame:
    ahead = calendar.in_horizon(F.col("date"), F.col("seen_on"), b.SETTINGS.calendar_horizon_days)
    return upcoming(spark, sf).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ahead.alias("ahead"))


@query("f19_event_sort_key", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN length(date) = 10 THEN date ELSE date || '-32' END AS sort_key FROM upcoming")
def event_sort_key(spark: SparkSession, sf: str) -> DataFrame:
    return upcoming(spark, sf).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", times.event_sort_key(F.col("date")).alias("sort_key")
    )


@query("o7_calendar_order", """
SELECT CAST(seen_on AS VARCHAR) AS seen_on, l_orderkey, l_linenumber, l_partkey, l_suppkey,
       row_number() OVER (PARTITION BY seen_on ORDER BY CASE WHEN length(date) = 10 THEN date ELSE date || '-32' END, title, l_orderkey, l_partkey, l_linenumber, l_suppkey) AS position
FROM upcoming
""")
def calendar_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = cut(_announcements(spark, sf).withColumn("sort_key", times.event_sort_key(F.col("date"))))
    placed = rank_in_group(rows, ["seen_on"], [("sort_key", True), ("title", True)], "pos", "position")
    return day(placed.select("seen_on", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "position"), "seen_on")


# ---- marts ---------------------------------------------------------------------------------------------
@query("s15_dashboard_mart", f"""
SELECT CAST(p.issue_date AS VARCHAR) AS issue_date, p.n, p.leads, p.stories_with_events, p.events, langs.en, langs.zh, langs.other, w.week_n, w.week_days
FROM (SELECT s.issue_date, count(*) AS n, count(*) FILTER (WHERE placement = 'lead') AS leads, count(e.id) AS stories_with_events, CAST(coalesce(sum(e.k), 0) AS BIGINT) AS events
      FROM placed_day s LEFT JOIN (SELECT id, count(*) AS k FROM news_study GROUP BY id) e ON e.id = s.id GROUP BY s.issue_date) p
JOIN (SELECT day_date AS issue_date, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'zh') AS zh, count(*) FILTER (WHERE lang = 'other') AS other
      FROM sources JOIN items ON id = item_id GROUP BY day_date) langs USING (issue_date)
JOIN (SELECT as_of AS issue_date, count(*) AS week_n, count(DISTINCT issue_date) AS week_days FROM week_pool GROUP BY as_of) w USING (issue_date)
WHERE p.issue_date > (SELECT max(issue_date) FROM scored_day) - {{days}}
""".replace("{days}", "3000"))
def dashboard_mart(spark: SparkSession, sf: str) -> DataFrame:
    """The mart's counts per issue over all issues (the dashboard keeps the last 30 days)."""
    placed = placed_days(spark, sf)
    events = study(spark, sf).select("id", "symbol", "status", "day0", "car", "t")
    named = entities(spark, sf)
    week = views.rolling_summary(placed, b.TOPICS)
    langs = b.sources(spark, sf).select("item_id", "lang")
    archived = placed.select("issue_date").distinct()
    end = archived.agg(F.max("issue_date")).first()[0]
    trend = views.trend(placed, archived, F.lit(end), b.SETTINGS.dashboard_days + 29, b.TOPICS)
    recap = views.weekly_recap(placed, named, b.sources(spark, sf), b.TOPICS, b.LANGS, b.SETTINGS)["summary"]
    path = work_path(spark, "dashboard")
    whole = replace(b.SETTINGS, dashboard_days=3000)
    marts.write_dashboard(marts.dashboard_tables(placed, events, week, langs, trend, recap, b.LANGS, whole), path)
    return day(marts.read_dashboard(spark, path))


cte("mart_newest", "SELECT max(issue_date) AS newest FROM scored_day")
cte("mart_days", "SELECT DISTINCT issue_date FROM scored_day, mart_newest WHERE issue_date > newest - 30")
cte("mart_lessons", f"""
SELECT newest - CAST(doc_id % 40 AS INTEGER) AS issue_date, {b.sql_list([g.id for g in GAPS])}[doc_id % 5 + 1] AS gap, CAST(10 + doc_id % 30 AS BIGINT) AS minutes
FROM labels, mart_newest WHERE quality = 1
""")
cte("mart_weeks", "SELECT date_trunc('week', issue_date) AS monday, count(*) AS n, count(DISTINCT issue_date) AS issues FROM scored_day GROUP BY ALL ORDER BY monday DESC LIMIT 8")


@query("s15_dashboard_parts", """
SELECT 'calendar' AS part, CAST(as_of AS VARCHAR) AS issue_date, e.kind AS key, count(*) AS n, count(DISTINCT date) AS amount
FROM calendar_rows WHERE as_of IN (SELECT issue_date FROM mart_days) GROUP BY ALL
UNION ALL SELECT 'learn', CAST(issue_date AS VARCHAR), gap, count(*), CAST(sum(minutes) AS BIGINT) FROM mart_lessons WHERE issue_date IN (SELECT issue_date FROM mart_days) GROUP BY ALL
UNION ALL SELECT 'tracker', CAST(d.issue_date AS VARCHAR), g.gap, count(l.gap), CAST(coalesce(sum(l.minutes), 0) AS BIGINT)
FROM mart_days d CROSS JOIN gap_list g LEFT JOIN mart_lessons l ON l.gap = g.gap AND l.issue_date BETWEEN d.issue_date - 29 AND d.issue_date GROUP BY ALL
UNION ALL SELECT 'trend', CAST(d AS VARCHAR), NULL, count(s.id), CAST(count(s.id) = 0 AS BIGINT)
FROM (SELECT CAST(unnest(generate_series(newest - 58, newest, INTERVAL 1 DAY)) AS DATE) AS d FROM mart_newest) LEFT JOIN scored_day s ON s.issue_date = d GROUP BY d
UNION ALL SELECT 'weeks', CAST(CAST(monday AS DATE) + 6 AS VARCHAR), strftime(monday, '%G-W%V'), n, issues FROM mart_weeks, mart_newest WHERE CAST(monday AS DATE) + 6 <= newest
""")
def dashboard_parts(spark: SparkSession, sf: str) -> DataFrame:
    """The mart of the last 30 days, written and read back: calendar, lessons, tracker, trend and closed weeks."""
    placed = placed_days(spark, sf)
    newest = F.lit(placed.agg(F.max("issue_date")).first()[0])
    days = placed.filter(F.col("issue_date") > F.date_sub(newest, b.SETTINGS.dashboard_days)).select(F.col("issue_date").alias("as_of")).distinct()
    taught = b.table(spark, sf, "labels").filter("quality = 1").select(
        F.date_sub(newest, (F.col("doc_id") % 40).cast("int")).alias("issue_date"), b.one_of(F.col("doc_id"), tuple(g.id for g in GAPS[:5])).alias("gap"),
        (10 + F.col("doc_id") % 30).alias("minutes"),
    )
    ahead = calendar.calendar_days(calendar.daily_and_weekly(*calendar_sources(spark, sf)), days, b.SETTINGS)
    archived = placed.select("issue_date").distinct()
    named = entities(spark, sf)
    tables = marts.dashboard_tables(
        placed, study(spark, sf).select("id", "symbol", "status", "day0", "car", "t"), views.rolling_summary(placed, b.TOPICS), b.sources(spark, sf).select("item_id", "lang"),
        views.trend(placed, archived, newest, b.SETTINGS.dashboard_days + 29, b.TOPICS),
        views.weekly_recap(placed, named, b.sources(spark, sf), b.TOPICS, b.LANGS, b.SETTINGS)["summary"], b.LANGS, b.SETTINGS,
        calendar=ahead, lessons=taught, tracker=learn.tracker_days(taught, GAPS, days, b.SETTINGS),
    )
    path = work_path(spark, "dashboard")
    marts.write_dashboard(tables, path)
    return day(marts.read_parts(spark, path, b.TOPICS))


@query("s16_feed_entry_mart", """
SELECT id, title, strftime(updated, '%Y-%m-%dT%H:%M:%SZ') AS updated FROM (
  SELECT 'daily-' || strftime(day_date, '%Y-%m-%d') AS id, 'Daily ' || strftime(day_date, '%Y-%m-%d') AS title, CAST(day_date AS TIMESTAMP) + INTERVAL 22 HOUR AS updated FROM items GROUP BY day_date
  UNION ALL
  SELECT 'weekly-' || strftime(week_date, '%G-W%V'), 'Weekly ' || strftime(week_date, '%G-W%V'), CAST(week_date + 6 AS TIMESTAMP) + INTERVAL 23 HOUR FROM items GROUP BY week_date)
ORDER BY updated DESC LIMIT 60
""")
def feed_entry_mart(spark: SparkSession, sf: str) -> DataFrame:
    items = sourced(spark, sf)
    dailies = items.select("issue_date", (F.col("issue_date").cast("timestamp") + F.make_dt_interval(hours=F.lit(22))).alias("window_end")).distinct()
    weeklies = items.select(times.week_id(F.col("issue_date")).alias("week")).distinct()
    entries = marts.feed_entries(dailies, weeklies)
    return entries.select("id", "title", times.fmt_ts(F.col("updated")).alias("updated"))


# ---- rebuild and compare ------------------------------------------------------------------------------------
cte("stored_scores", """
SELECT id, issue_date, CASE WHEN id % 97 = 0 THEN total + 1 ELSE total END AS total, CASE WHEN id % 101 = 0 THEN 'lead' ELSE placement END AS placement, rank FROM placed_week WHERE id % 103 > 0
""")
_CHECK_SQL = """
SELECT 'fresh' AS side, id, CAST(issue_date AS VARCHAR) AS issue_date, total, placement, rank FROM (SELECT id, issue_date, total, placement, rank FROM placed_week EXCEPT ALL SELECT id, issue_date, total, placement, rank FROM stored_scores)
UNION ALL
SELECT 'stored', id, CAST(issue_date AS VARCHAR), total, placement, rank FROM (SELECT id, issue_date, total, placement, rank FROM stored_scores EXCEPT ALL SELECT id, issue_date, total, placement, rank FROM placed_week)
"""


def _fresh_and_stored(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    fresh = cut(placement.place(b.scored(spark, sf), b.SETTINGS).select("id", "issue_date", "total", "placement", "rank"))
    i = F.col("id")
    edited = fresh.filter(i % 103 > 0).withColumns({
        "total": F.when(i % 97 == 0, F.col("total") + 1).otherwise(F.col("total")),
        "placement": F.when(i % 101 == 0, "lead").otherwise(F.col("placement")),
    })
    path = work_path(spark, "stored")
    archive.write_archive(edited, path, "issue_date", spread="id")
    return fresh, archive.read_archive(spark, path).select(*fresh.columns)


@query("s17_rebuild_and_diff", f"SELECT issue_date, count(*) FILTER (WHERE side = 'fresh') AS fresh, count(*) FILTER (WHERE side = 'stored') AS stored FROM ({_CHECK_SQL}) GROUP BY issue_date")
def rebuild_and_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Issues whose stored scores or placement differ from a fresh build of hand-edited data."""
    diff = marts.difference(*_fresh_and_stored(spark, sf))
    return day(diff.groupBy("issue_date").agg(
        F.count_if(F.col("side") == "fresh").alias("fresh"), F.count_if(F.col("side") == "stored").alias("stored")
    ))


@query("u6_stored_vs_fresh", _CHECK_SQL)
def stored_vs_fresh(spark: SparkSession, sf: str) -> DataFrame:
    return day(marts.difference(*_fresh_and_stored(spark, sf)))
