"""Duplicates, similar headlines, clusters and the harvested lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, urls
from ..operators import approximate, clusters, components, dedupe, forest, harvest, similarity
from ..session import dealt, stored
from . import bindings as b
from .registry import cte, query

# ---- same link -------------------------------------------------------------------------
cte("item_links", """
SELECT DISTINCT item_id AS id, week_date AS issue_date, 'https://' || domain || '/section-' || part_key % 20 AS url
FROM sources JOIN items ON items.id = item_id
""")
cte("link_follow_ups", """
SELECT id, min(target) AS follow_up_of
FROM (SELECT max(id) AS id, min(id) AS target FROM item_links GROUP BY url, issue_date HAVING count(*) > 1) GROUP BY id
""")
cte("link_pairs", """
SELECT a.id, b.id AS other_id, a.url, a.issue_date, b.issue_date AS other_date
FROM item_links a JOIN item_links b ON a.url = b.url
  AND (b.issue_date BETWEEN a.issue_date - 7 AND a.issue_date - 1 OR (b.issue_date = a.issue_date AND b.id < a.id))
LEFT JOIN link_follow_ups f ON f.id = a.id WHERE f.follow_up_of IS DISTINCT FROM b.id
""")


def item_links(spark: SparkSession, sf: str) -> DataFrame:
    items = b.all_items(spark, sf).select(F.col("id").alias("item_id"), "issue_date")
    section = F.concat(
        F.lit("HTTP://www."), "domain", F.lit("/section-"), (F.col("part_key") % 20).cast("string"),
        F.lit("/?ref=x#top"),
    )
    lines = urls.with_canonical_url(b.sources(spark, sf), section, "url").select("item_id", "url")
    return (
        dealt(lines, b.table(spark, sf, "lineitem").count(), "item_id")
        .join(items, "item_id")
        .select(F.col("item_id").alias("id"), "issue_date", "url")
        .distinct()
    )


def link_follow_ups(links: DataFrame) -> DataFrame:
    cells = links.groupBy("url", "issue_date").agg(
        F.max("id").alias("id"), F.min("id").alias("target"), F.count(F.lit(1)).alias("n")
    )
    return cells.filter("n > 1").groupBy("id").agg(F.min("target").alias("follow_up_of"))


@query("j1_url_duplicates", """
SELECT url, CAST(issue_date AS VARCHAR) AS issue_date, CAST(other_date AS VARCHAR) AS other_date, count(*) AS n_pairs
FROM link_pairs GROUP BY ALL
""")
def url_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    links = stored(item_links(spark, sf), "links")
    return dedupe.url_conflicts(links, link_follow_ups(links)).select(
        "url", b.day_text(F.col("issue_date")).alias("issue_date"), b.day_text(F.col("other_date")).alias("other_date"), "n_pairs"
    )


@query("j1_url_duplicates_by_item", """
SELECT id, CAST(issue_date AS VARCHAR) AS issue_date, count(*) AS n_conflicts, min(url) AS detail FROM link_pairs GROUP BY ALL
""")
def url_duplicates_by_item(spark: SparkSession, sf: str) -> DataFrame:
    links, names = dedupe.numbered_links(stored(item_links(spark, sf), "links"))
    found = dedupe.url_conflicts_by_item(links, link_follow_ups(links))
    return found.join(names, F.col("detail") == F.col("url")).select(
        "id", b.day_text(F.col("issue_date")).alias("issue_date"), "n_conflicts", F.col("link").alias("detail")
    )


@query("j3_follow_up_exclusion", """
SELECT f.id, f.follow_up_of, count(*) AS shared_links
FROM link_follow_ups f JOIN item_links a ON a.id = f.id JOIN item_links o ON o.id = f.follow_up_of AND o.url = a.url
WHERE o.issue_date BETWEEN a.issue_date - 7 AND a.issue_date AND (o.issue_date < a.issue_date OR o.id < a.id) GROUP BY ALL
""")
def follow_up_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    """The pairs that a follow-up mark takes out of the conflicts."""
    links = stored(item_links(spark, sf), "links")
    return dedupe.exempt_pairs(links, link_follow_ups(links)).groupBy("id", "follow_up_of").agg(
        F.count(F.lit(1)).alias("shared_links")
    )


@query("j4_duplicate_ids", """
SELECT CAST(week_date AS VARCHAR) AS issue_date, l_partkey AS id, count(*) - 1 AS n_conflicts
FROM lineitem JOIN (SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_date FROM orders) ON l_orderkey = o_orderkey
GROUP BY ALL HAVING count(*) > 1
""")
def duplicate_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Parts used as story ids of the order's week."""
    orders = b.table(spark, sf, "orders").select("o_orderkey", F.to_date(F.date_trunc("week", "o_orderdate")).alias("issue_date"))
    lines = b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("id"))
    return dedupe.duplicate_ids(lines.join(orders, "o_orderkey")).withColumn("issue_date", b.day_text(F.col("issue_date")))


# ---- similar titles ------------------------------------------------------------------------
cte("titles", f"SELECT id, issue_date, [outlet, tier] AS entities, {b.TITLE_WORDS_SQL.format('title')} AS tokens FROM headlines")
cte("title_sets", "SELECT tokens, min(id) AS set_id FROM titles WHERE len(tokens) > 0 GROUP BY tokens")
cte("title_follow_ups", "SELECT max(id) AS id, min(id) AS follow_up_of FROM headlines GROUP BY title HAVING count(*) > 2")


cte("title_links", """
SELECT id, issue_date, unnest([ 'https://' || outlet || '.example.com/' || n_chars, 'https://agg.example.com/' || id % 40]) AS url FROM headlines
""")


def _titles(spark: SparkSession, sf: str) -> DataFrame:
    return b.headlines(spark, sf).select("id", "title", "issue_date", F.array("outlet", "tier").alias("entities"))


@query("j2_similar_titles", """
WITH links AS (SELECT id, list(url) AS links FROM title_links GROUP BY id),
keyed AS (SELECT id, issue_date, list_sort(entities) AS entities, tokens, set_id, links FROM titles JOIN title_sets USING (tokens) JOIN links USING (id)),
pairs AS (
  SELECT a.id, b.id AS other_id, a.set_id AS own, b.set_id AS their, a.entities AS ea, b.entities AS eb, a.issue_date AS da, b.issue_date AS db,
         len(list_intersect(a.tokens, b.tokens)) AS shared, len(a.tokens) + len(b.tokens) AS total
  FROM keyed a JOIN keyed b ON (b.issue_date BETWEEN a.issue_date - 7 AND a.issue_date - 1 OR (b.issue_date = a.issue_date AND b.id < a.id))
       AND list_has_any(a.entities, b.entities)
  LEFT JOIN title_follow_ups f ON f.id = a.id WHERE f.follow_up_of IS DISTINCT FROM b.id AND NOT list_has_any(a.links, b.links))
SELECT set_a, set_b, CAST(da AS VARCHAR) AS date_a, CAST(db AS VARCHAR) AS date_b, array_to_string(entities_a, ',') AS entities_a,
       array_to_string(entities_b, ',') AS entities_b, count(*) AS n_pairs, round(max(j), 6) AS jaccard
FROM (SELECT *, shared / CAST(total - shared AS DOUBLE) AS j, (da = db AND (own, ea) > (their, eb)) AS flip,
             CASE WHEN flip THEN their ELSE own END AS set_a, CASE WHEN flip THEN own ELSE their END AS set_b,
             CASE WHEN flip THEN eb ELSE ea END AS entities_a, CASE WHEN flip THEN ea ELSE eb END AS entities_b
      FROM pairs) WHERE j >= 0.5 GROUP BY ALL
""")
def similar_titles(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of cells with similar titles; a pair of items with a common link is reported by its link and left out."""
    items = _titles(spark, sf)
    found = dedupe.title_conflicts(
        items, text.title_tokens(F.col("title")), _title_follow_ups(items), b.SETTINGS.title_jaccard, item_urls=title_links(spark, sf)
    )
    return found.select(
        "set_a", "set_b", b.day_text(F.col("date_a")).alias("date_a"), b.day_text(F.col("date_b")).alias("date_b"),
        F.array_join("entities_a", ",").alias("entities_a"), F.array_join("entities_b", ",").alias("entities_b"),
        "n_pairs", F.round("jaccard", 6).alias("jaccard"),
    )


cte("title_only", """
SELECT a.id, a.issue_date FROM titles a JOIN titles b
  ON (b.issue_date BETWEEN a.issue_date - 7 AND a.issue_date - 1 OR (b.issue_date = a.issue_date AND b.id < a.id)) AND list_has_any(a.entities, b.entities)
LEFT JOIN title_follow_ups f ON f.id = a.id
WHERE f.follow_up_of IS DISTINCT FROM b.id AND len(a.tokens) > 0 AND len(b.tokens) > 0
  AND len(list_intersect(a.tokens, b.tokens)) / CAST(len(a.tokens) + len(b.tokens) - len(list_intersect(a.tokens, b.tokens)) AS DOUBLE) >= 0.5
  AND NOT EXISTS (SELECT 1 FROM title_links x JOIN title_links y ON x.url = y.url WHERE x.id = a.id AND y.id = b.id)
""")


def title_links(spark: SparkSession, sf: str) -> DataFrame:
    """Two links of every headline: one that copies of an outlet share, and one of an aggregator."""
    rows = b.headlines(spark, sf)
    own = F.concat(F.lit("https://"), "outlet", F.lit(".example.com/"), F.col("n_chars").cast("string"))
    other = F.concat(F.lit("https://agg.example.com/"), (F.col("id") % 40).cast("string"))
    return rows.select("id", "issue_date", F.explode(F.array(own, other)).alias("url")).distinct()


def _title_follow_ups(items: DataFrame) -> DataFrame:
    copies = items.groupBy("title").agg(F.max("id").alias("id"), F.min("id").alias("follow_up_of"), F.count(F.lit(1)).alias("n"))
    return copies.filter("n > 2").select("id", "follow_up_of")


@query("j2_title_duplicates_by_item", "SELECT id, CAST(issue_date AS VARCHAR) AS issue_date, count(*) AS n_conflicts FROM title_only GROUP BY ALL")
def title_duplicates_by_item(spark: SparkSession, sf: str) -> DataFrame:
    """Similar titles per item, without pairs that a common link already reports."""
    items = _titles(spark, sf)
    found = dedupe.title_conflicts_by_item(
        items, text.title_tokens(F.col("title")), title_links(spark, sf), _title_follow_ups(items), b.SETTINGS.title_jaccard
    )
    return found.withColumn("issue_date", b.day_text(F.col("issue_date")))


@query("j1_j2_j4_conflict_report", """
SELECT a.id, CAST(a.issue_date AS VARCHAR) AS issue_date, 'url' AS reason, count(*) AS n_conflicts, min(a.url) AS detail
FROM title_links a JOIN title_links b ON a.url = b.url AND (b.issue_date BETWEEN a.issue_date - 7 AND a.issue_date - 1 OR (b.issue_date = a.issue_date AND b.id < a.id))
LEFT JOIN title_follow_ups f ON f.id = a.id WHERE f.follow_up_of IS DISTINCT FROM b.id GROUP BY ALL
UNION ALL
SELECT id, CAST(issue_date AS VARCHAR), 'title', count(*), NULL FROM title_only GROUP BY ALL
UNION ALL
SELECT id, CAST(issue_date AS VARCHAR), 'id', count(*) - 1, 'duplicate id' FROM headlines GROUP BY ALL HAVING count(*) > 1
""")
def conflict_report(spark: SparkSession, sf: str) -> DataFrame:
    """All conflicts of an item by reason; a pair counts under one reason only."""
    items = _titles(spark, sf)
    found = dedupe.conflict_report(
        items, text.title_tokens(F.col("title")), title_links(spark, sf), _title_follow_ups(items), b.SETTINGS.title_jaccard
    )
    return found.withColumn("issue_date", b.day_text(F.col("issue_date")))


cte("cluster_words", f"SELECT id, {b.CLUSTER_WORDS_SQL.format('title')} AS tokens FROM headlines")
cte("cluster_sets", "SELECT tokens, min(id) AS set_id, count(*) AS n_items FROM cluster_words WHERE len(tokens) > 0 GROUP BY tokens")
cte("cluster_pairs", """
SELECT a.set_id AS set_a, b.set_id AS set_b, len(list_intersect(a.tokens, b.tokens)) AS shared,
       len(list_intersect(a.tokens, b.tokens)) / CAST(len(a.tokens) + len(b.tokens) - len(list_intersect(a.tokens, b.tokens)) AS DOUBLE) AS j
FROM cluster_sets a JOIN cluster_sets b ON a.set_id < b.set_id AND len(a.tokens) >= 0.4 * len(b.tokens) AND len(b.tokens) >= 0.4 * len(a.tokens)
WHERE j >= 0.4
""")
cte("reached", """
SELECT set_id AS node, set_id AS label FROM cluster_sets
UNION
SELECT e.y, r.label FROM reached r JOIN (SELECT set_a AS x, set_b AS y FROM cluster_pairs UNION ALL SELECT set_b, set_a FROM cluster_pairs) e
  ON e.x = r.node WHERE r.label < e.y
""")
cte("set_components", "SELECT node, min(label) AS component FROM reached GROUP BY node")
cte("clustered", """
SELECT h.*, coalesce(c.component, h.id) AS component,
       CASE WHEN via = 'hn' THEN n_chars END AS hn_points, CASE WHEN via = 'hf' THEN n_chars END AS hf_upvotes
FROM headlines h JOIN cluster_words w ON h.id = w.id LEFT JOIN cluster_sets s ON s.tokens = w.tokens
LEFT JOIN set_components c ON c.node = s.set_id
""")
cte("cluster_rows", """
SELECT component, count(*) AS n_items, count(DISTINCT outlet) AS n_outlets,
       min(published_at) AS first_seen, coalesce(max(hn_points), 0) AS hn_points, coalesce(max(hf_upvotes), 0) AS hf_upvotes,
       first(id ORDER BY CASE tier WHEN 'primary' THEN 0 WHEN 'press' THEN 1 WHEN 'trade' THEN 2 ELSE 3 END, via = 'gnews', published_at, id) AS best_id
FROM clustered GROUP BY component
""")


def _cluster_words() -> object:
    return text.cluster_tokens(F.col("title"))


@query("j14_similar_headlines", """
SELECT set_a, set_b, CAST(shared AS INTEGER) AS shared, round(j, 6) AS jaccard FROM cluster_pairs
""")
def similar_headlines(spark: SparkSession, sf: str) -> DataFrame:
    """Pairs of distinct token sets of headlines; each set stands for all its copies."""
    sets = similarity.distinct_sets(b.headlines(spark, sf), "id", _cluster_words())
    return similarity.similar_sets(sets, b.SETTINGS.cluster_jaccard).withColumn("jaccard", F.round("jaccard", 6))


@query("j14_approximate_join", "SELECT count(*) AS pairs, CAST(0 AS BIGINT) AS wrong, true AS enough FROM cluster_pairs")
def approximate_join(spark: SparkSession, sf: str) -> DataFrame:
    """The MinHash join against the exact one: nothing that is not similar, and at least nine tenths of the pairs."""
    sets = stored(similarity.distinct_sets(b.headlines(spark, sf), "id", _cluster_words()), "sets")
    found = approximate.similar_sets_by_minhash(sets, b.SETTINGS.cluster_jaccard)
    rated = approximate.recall(found, similarity.similar_sets(sets, b.SETTINGS.cluster_jaccard))
    return rated.select("pairs", "wrong", (F.col("recall") >= 0.9).alias("enough"))


@query("a19_components", "SELECT node, component FROM set_components WHERE node IN (SELECT set_a FROM cluster_pairs UNION ALL SELECT set_b FROM cluster_pairs)")
def connected(spark: SparkSession, sf: str) -> DataFrame:
    sets = similarity.distinct_sets(b.headlines(spark, sf), "id", _cluster_words())
    return components.connected_components(forest.similar_forest(sets, b.SETTINGS.cluster_jaccard), "set_a", "set_b")


def cluster_members(spark: SparkSession, sf: str) -> DataFrame:
    items = b.headlines(spark, sf).drop("text").withColumns({
        "url": F.concat(F.lit("https://"), "outlet", F.lit(".example.com/"), F.col("id").cast("string")),
        "hn_points": F.when(F.col("via") == "hn", F.col("n_chars")),
        "hf_upvotes": F.when(F.col("via") == "hf", F.col("n_chars")),
    })
    return clusters.headline_clusters(items, _cluster_words(), b.SETTINGS.cluster_jaccard)


def cluster_table(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.roll_up(cluster_members(spark, sf))


@query("a18_cluster_roll_up", """
SELECT component, n_items, n_outlets, strftime(first_seen, '%Y-%m-%dT%H:%M:%SZ') AS first_seen, hn_points, hf_upvotes, best_id FROM cluster_rows
""")
def cluster_roll_up(spark: SparkSession, sf: str) -> DataFrame:
    return cluster_table(spark, sf).select(
        "component", "n_items", "n_outlets",
        F.date_format("first_seen", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("first_seen"), "hn_points", "hf_upvotes", "best_id",
    )


@query("a18_cluster_outlets", "SELECT component, outlet, count(*) AS n_items FROM clustered GROUP BY component, outlet")
def cluster_outlets(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.cluster_outlets(cluster_members(spark, sf))


@query("a18_cluster_members", "SELECT component, id, row_number() OVER (PARTITION BY component ORDER BY published_at, id) AS position FROM clustered")
def cluster_places(spark: SparkSession, sf: str) -> DataFrame:
    """Every item with its cluster and its place there, oldest first."""
    members = cluster_members(spark, sf).select("component", "id", "published_at")
    return clusters.placed_members(members).select("component", "id", "position")


@query("o1_cluster_order", """
SELECT lang, CAST(rn AS BIGINT) AS rn, component FROM (
  SELECT h.lang, component, row_number() OVER (PARTITION BY h.lang ORDER BY n_outlets DESC, hn_points DESC, first_seen, h.title, component) AS rn
  FROM cluster_rows JOIN headlines h ON h.id = best_id) WHERE (lang = 'en' AND rn <= 40) OR (lang = 'fr' AND rn <= 20)
""")
def cluster_order(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.top_clusters(cluster_table(spark, sf), {"en": 40, "fr": 20}).select(
        "lang", F.col("rn").cast("bigint").alias("rn"), "component"
    )


# ---- harvested items -------------------------------------------------------------------------
#: The fixed pattern for an engine whose word borders are those of ASCII: spelled out, and A.I. (whose last border stands
#: between a dot and a letter) apart.
_NO_WORD, _IN_WORD = r"[^\p{L}\p{N}_]", r"[\p{L}\p{N}_]"
_WORDS = text.TOPICAL_WORDS.removeprefix(r"\b(").removesuffix(r")\b").replace(r"|A\.I\.", "")
_STRICT_SQL = (
    f"(regexp_matches(text, '(?i)(^|{_NO_WORD})({_WORDS})($|{_NO_WORD})') OR regexp_matches(text, '(?i)(^|{_NO_WORD})A\\.I\\.{_IN_WORD}') "
    f"OR regexp_matches(text, '(?i){text.TOPICAL_TERMS}'))"
)


@query("p1_topical_filter", f"""
SELECT doc_id, regexp_matches(text, '(?i)ai') OR strict AS loose, strict FROM (SELECT doc_id, text, {_STRICT_SQL} AS strict FROM documents)
""")
def topical_filter(spark: SparkSession, sf: str) -> DataFrame:
    return b.table(spark, sf, "documents").select(
        "doc_id", text.is_topical(F.col("text")).alias("loose"), text.is_topical(F.col("text"), strict=True).alias("strict")
    )


NOW = "2024-01-20 12:00:00"


@query("p2_harvest_range", f"""
SELECT id, published_at BETWEEN TIMESTAMP '{NOW}' - INTERVAL 36 HOUR AND TIMESTAMP '{NOW}' + INTERVAL 1 HOUR AS in_range FROM headlines
""")
def harvest_range(spark: SparkSession, sf: str) -> DataFrame:
    now = F.lit(NOW).cast("timestamp_ntz")
    return b.headlines(spark, sf).select("id", harvest.in_harvest_range(F.col("published_at"), now, b.SETTINGS).alias("in_range"))


KNOWN_OUTLETS = {"src0.example.net": ("Src0", "primary"), "src1.example.net": ("Src1", "social"), "src2.example.net": ("Src2", "trade")}


def feed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as parsed feed rows, aggregator titles ending in their outlet."""
    gnews = F.col("via") == "gnews"
    return b.headlines(spark, sf).select(
        F.concat(F.lit("feed-"), "lang").alias("feed"), F.col("via").alias("kind"), "tier", "lang",
        (F.col("lang") == "de").alias("filter"), F.lit(0).alias("feed_pos"), F.col("id").alias("row_pos"),
        F.when(gnews, F.concat("title", F.lit(" - "), "outlet")).otherwise(F.col("title")).alias("title"),
        F.concat(F.lit(" http://www.Example.com/"), F.col("id").cast("string"), F.lit("/?utm_source=x ")).alias("url"),
        "published_at", F.col("text").alias("summary"),
        F.when(gnews, F.col("outlet")).otherwise(F.lit("")).alias("outlet"),
        F.when(gnews, F.concat(F.lit("https://www."), "outlet", F.lit(".example.net"))).alias("outlet_url"),
        F.struct(
            F.when(F.col("via") == "hf", F.col("n_chars")).alias("hf_upvotes"),
            F.when(F.col("via") == "hn", F.col("n_chars")).alias("hn_points"),
            F.lit(None).cast("bigint").alias("hn_comments"),
            F.lit(None).cast("string").alias("hn_url"),
        ).alias("signals"),
    )


#: Topical as far as these texts go: the loose and the strict pattern on their words.
TOPICAL_SQL = r"""(regexp_matches({0}, '(?i)ai')
  OR regexp_matches({0}, '(?i)(^|[^\p{{L}}\p{{N}}_])(agents?|chips?|robot\w*|neural|transformer|inference|diffusion|multimodal|LLMs?|GPUs?)($|[^\p{{L}}\p{{N}}_])'))"""
CLEAN_SQL = "trim(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g'))"


@query("p6_normalise", f"""
WITH c AS (SELECT *, {CLEAN_SQL.format("title || CASE via WHEN 'gnews' THEN ' - ' || outlet ELSE '' END")} AS t, {CLEAN_SQL.format('text')} AS s FROM headlines),
d AS (SELECT *, CASE WHEN length(t) <= 300 THEN t ELSE rtrim(substr(t, 1, 299)) || '…' END AS t2,
             CASE WHEN length(s) <= 600 THEN s ELSE rtrim(substr(s, 1, 599)) || '…' END AS summary FROM c),
e AS (SELECT *, CASE WHEN via = 'gnews' AND ends_with(t2, ' - ' || outlet) THEN left(t2, length(t2) - length(outlet) - 3) ELSE t2 END AS clean_title FROM d)
SELECT substr(sha1('https://example.com/' || id), 1, 12) AS id, clean_title AS title, 'http://www.Example.com/' || id || '/?utm_source=x' AS url, summary,
       CASE via WHEN 'gnews' THEN outlet ELSE 'feed-' || lang END AS outlet,
       CASE WHEN via <> 'gnews' THEN tier WHEN outlet = 'src0' THEN 'primary' WHEN outlet = 'src1' THEN 'social' WHEN outlet = 'src2' THEN 'trade' ELSE 'press' END AS tier
FROM e WHERE lang <> 'de' OR {TOPICAL_SQL.format("clean_title || ' ' || summary")}
""")
def normalise(spark: SparkSession, sf: str) -> DataFrame:
    done = harvest.normalise(feed_rows(spark, sf), KNOWN_OUTLETS, b.SETTINGS)
    return done.select("id", "title", "url", "summary", "outlet", "tier")


cte("arrivals", """
SELECT user_id || '-' || event_type AS id, date_trunc('day', ts) AS published_at, event_id,
       (event_id % 3) * 1000000000 + event_id AS position,
       CASE WHEN event_id % 2 = 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS hf_upvotes,
       CASE WHEN event_id % 5 < 2 THEN CAST(floor(value) AS BIGINT) END AS hn_points
FROM events
""")


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Events as harvested rows of three feeds; a user and event type make one story id."""
    e = F.col("event_id")
    return b.table(spark, sf, "events").select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), "event_type").alias("id"),
        F.date_trunc("day", "ts").alias("published_at"),
        "event_id",
        ((e % 3) * 1000000000 + e).alias("position"),
        F.struct(
            F.when(e % 2 == 0, F.get_json_object("props", "$.k").cast("bigint")).alias("hf_upvotes"),
            F.when(e % 5 < 2, F.floor("value").cast("bigint")).alias("hn_points"),
            F.lit(None).cast("bigint").alias("hn_comments"),
            F.lit(None).cast("string").alias("hn_url"),
        ).alias("signals"),
    )


@query("a12_merge_by_id", """
WITH m AS (SELECT *, coalesce(published_at >= min(published_at) OVER (PARTITION BY id ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late FROM arrivals)
SELECT id, first(event_id ORDER BY published_at, position) AS event_id, strftime(min(published_at), '%Y-%m-%d') AS day,
       coalesce(last(hf_upvotes ORDER BY position) FILTER (WHERE late AND hf_upvotes IS NOT NULL), first(hf_upvotes ORDER BY position) FILTER (WHERE hf_upvotes IS NOT NULL)) AS hf_upvotes,
       coalesce(last(hn_points ORDER BY position) FILTER (WHERE late AND hn_points IS NOT NULL), first(hn_points ORDER BY position) FILTER (WHERE hn_points IS NOT NULL)) AS hn_points
FROM m GROUP BY id
""")
def merge_by_id(spark: SparkSession, sf: str) -> DataFrame:
    return harvest.merge_by_id(arrivals(spark, sf)).select(
        "id", "event_id", b.day_text(F.col("published_at")).alias("day"), "signals.hf_upvotes", "signals.hn_points"
    )


@query("o2_primary_list", """
SELECT id, strftime(published_at, '%Y-%m-%dT%H:%M:%SZ') AS published_at FROM headlines WHERE tier = 'primary' AND via <> 'hf' ORDER BY published_at DESC, id DESC LIMIT 25
""")
def primary_list(spark: SparkSession, sf: str) -> DataFrame:
    rows = harvest.primary_list(b.headlines(spark, sf))
    return rows.select("id", F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published_at"))


@query("o3_papers_and_stories", """
SELECT * FROM (SELECT via, id, n_chars AS signal FROM headlines WHERE via = 'hf' ORDER BY n_chars DESC, published_at DESC, id DESC LIMIT 12)
UNION ALL
SELECT * FROM (SELECT via, id, n_chars AS signal FROM headlines WHERE via = 'hn' ORDER BY n_chars DESC, published_at DESC, id DESC LIMIT 12)
""")
def papers_and_stories(spark: SparkSession, sf: str) -> DataFrame:
    rows = b.headlines(spark, sf)
    papers = harvest.top_by_signal(rows, "hf", "n_chars")
    return papers.unionByName(harvest.top_by_signal(rows, "hn", "n_chars")).select("via", "id", F.col("n_chars").alias("signal"))


@query("o4_newest_first", """
SELECT id, row_number() OVER (PARTITION BY lang ORDER BY published_at DESC, id DESC) AS position FROM headlines
""")
def newest_first(spark: SparkSession, sf: str) -> DataFrame:
    """Position of every item among the newest of its language; ids grow with time here, so the id is
    the tie and a descending key."""
    from ..operators.ranking import rank_in_group

    rows = b.headlines(spark, sf).select("id", "lang", "issue_date", (-F.col("id")).alias("newest"))
    return rank_in_group(rows, ["lang"], [("issue_date", False)], "newest", "position").select("id", "position")


cte("fetches", """
SELECT host AS feed, page_id AS url_pos, page_id % 3 <> 0 AS ok, 'ParseError: ' || url || ' ' || repeat('x', 200) AS error FROM page_urls
""")


@query("s13_feed_outcomes", """
SELECT feed, bool_or(ok) AS ok, CASE WHEN bool_or(ok) THEN count(*) FILTER (WHERE ok) ELSE 0 END AS n,
       CASE WHEN NOT bool_or(ok) THEN substr(last(error ORDER BY url_pos), 1, 200) END AS error
FROM fetches GROUP BY feed
""")
def feed_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Pages as fetches of their host's feed; every third one failed."""
    attempts = b.pages(spark, sf).select(
        urls.domain_of(F.col("url")).alias("feed"), F.col("page_id").alias("url_pos"), (F.col("page_id") % 3 != 0).alias("ok"),
        F.concat(F.lit("ParseError: "), "url", F.lit(" " + "x" * 200)).alias("error"),
    )
    return harvest.feed_outcomes(attempts, attempts.filter("ok").select("feed"))


@query("p11_staleness", f"""
SELECT id, round(epoch(TIMESTAMP '{NOW}' - published_at) / 3600.0, 4) AS hours, epoch(TIMESTAMP '{NOW}' - published_at) / 3600.0 > 6 AS stale FROM headlines
""")
def staleness(spark: SparkSession, sf: str) -> DataFrame:
    age = harvest.staleness(F.col("published_at").cast("timestamp"), F.lit(NOW).cast("timestamp"))
    return b.headlines(spark, sf).select(
        "id", F.round(age, 4).alias("hours"), (age > b.SETTINGS.stale_hours).alias("stale")
    )
