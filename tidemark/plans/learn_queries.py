"""Learning track and calibration: gaps against documents, lessons from labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Gap
from ..functions import scores
from ..operators import calibration, learn
from . import bindings as b
from .registry import cte, query
from .view_queries import day

# --- fixed values: gaps for the test texts ----------------------------------------------
GAPS = [
    Gap("eval", "Evaluation", 2.5, 4.5, 1.0, ("tionble", "worthless", "edst")),
    Gap("internals", "Internals", 2.5, 4.5, 1.0, ("eaux", "queau", "ière")),
    Gap("training", "Training", 3.0, 4.5, 0.9, ("sch", "ung", "(c)")),
    Gap("rigor", "Rigor", 4.5, 5.0, 0.5, ("hawh", "inea", "on the")),
    Gap("done", "Done", 5.0, 4.0, 1.0, ("the",)),
    Gap("silent", "Silent", 3.5, 4.5, 0.7, ("no such word anywhere",)),
]


def _keyword_sql(k: str) -> str:
    escaped = k.replace("(", "\\(").replace(")", "\\)")
    return f"regexp_matches(lower(text), '(^|[^a-z0-9]){escaped}')"


def _hits_sql() -> str:
    rows = []
    for g in GAPS:
        words = ", ".join(f"CASE WHEN {_keyword_sql(k)} THEN '{k}' END" for k in g.keywords)
        rows.append(f"SELECT id, issue_date, '{g.id}' AS gap, list_filter([{words}], lambda k: k IS NOT NULL) AS keywords, weight FROM stories")
    return "SELECT * FROM (" + " UNION ALL ".join(rows) + ") WHERE len(keywords) > 0"


cte("stories", """
SELECT id, issue_date, text, coalesce((40.0 + 30 * quality - 20 * toxic) / CAST(100 AS DOUBLE), least(1.0, n_chars / CAST(20000 AS DOUBLE))) AS weight
FROM headlines LEFT JOIN labels ON doc_id = id
""")
cte("gap_hits", _hits_sql())
cte("gap_list", "SELECT * FROM (VALUES " + ", ".join(
    f"('{g.id}', '{g.label}', CAST({g.now} AS DOUBLE), CAST({g.target} AS DOUBLE), CAST({g.weight} AS DOUBLE))" for g in GAPS
) + ") v(gap, label, now, target, weight)")
cte("lessons", f"""
SELECT doc_id, issue_date, {b.sql_list([g.id for g in GAPS])}[doc_id % 5 + 1] AS gap, CAST(10 + doc_id % 30 AS BIGINT) AS minutes
FROM labels JOIN headlines ON id = doc_id WHERE quality = 1
""")
cte("gap_days", """
SELECT d.issue_date, gap, (SELECT max(l.issue_date) FROM lessons l WHERE l.gap = g.gap AND l.issue_date < d.issue_date) AS last_taught
FROM (SELECT DISTINCT issue_date FROM headlines) d, gap_list g
""")


def stories(spark: SparkSession, sf: str) -> DataFrame:
    labels = b.table(spark, sf, "labels").withColumnRenamed("doc_id", "id")
    total = F.lit(40.0) + 30 * F.col("quality") - 20 * F.col("toxic")
    impact = F.least(F.lit(1.0), F.col("n_chars") / F.lit(20000.0))
    return b.headlines(spark, sf).join(labels, "id", "left").select(
        "id", "issue_date", "text", learn.hook_weight(total, impact).alias("weight")
    )


def lessons(spark: SparkSession, sf: str) -> DataFrame:
    """Good documents as lessons on a gap; one gap is never taught."""
    good = b.table(spark, sf, "labels").filter("quality = 1").withColumnRenamed("doc_id", "id")
    gap = b.one_of(F.col("id"), tuple(g.id for g in GAPS[:5]))
    return good.join(b.headlines(spark, sf).select("id", "issue_date"), "id").select(
        "id", "issue_date", gap.alias("gap"), (10 + F.col("id") % 30).alias("minutes")
    )


def _matches(spark: SparkSession, sf: str) -> DataFrame:
    return learn.gap_matches(stories(spark, sf), F.col("text"), GAPS).drop("text")


@query("j11_gap_keywords", "SELECT id, gap, array_to_string(keywords, ',') AS keywords FROM gap_hits")
def gap_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return _matches(spark, sf).select("id", "gap", F.array_join("keywords", ",").alias("keywords"))


cte("word_keywords", """
SELECT w AS keyword, length(w) AS size, CASE WHEN length(w) % 2 = 0 THEN 'even' ELSE 'odd' END AS gap
FROM (SELECT DISTINCT substr(unnest(regexp_extract_all(lower(title), '[a-z0-9]+')), 1, 6) AS w FROM headlines)
""")


@query("j11_keyword_table", """
WITH words AS (SELECT id, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS w FROM headlines),
starts AS (SELECT DISTINCT id, substr(w, 1, size) AS start FROM words, range(1, 7) t(size) WHERE length(w) >= size)
SELECT id, gap, count(*) AS n, min(keyword) AS first, md5(string_agg(keyword, ',' ORDER BY keyword)) AS keywords
FROM starts JOIN word_keywords ON keyword = start GROUP BY id, gap
""")
def keyword_table(spark: SparkSession, sf: str) -> DataFrame:
    """Every story against thousands of keywords: the first six characters of all words of titles."""
    rows = b.headlines(spark, sf)
    words = rows.select(F.explode(F.regexp_extract_all(F.lower("title"), F.lit("[a-z0-9]+"), F.lit(0))).alias("word"))
    words = words.select(F.left("word", F.lit(6)).alias("keyword")).distinct()
    gap = F.when(F.length("keyword") % 2 == 0, "even").otherwise("odd")
    found = learn.keyword_matches(rows, "id", F.col("text"), words.select(gap.alias("gap"), F.col("keyword").alias("pos"), "keyword"))
    listed = F.md5(F.array_join("keywords", ","))
    return found.select("id", "gap", F.size("keywords").cast("bigint").alias("n"), F.get("keywords", F.lit(0)).alias("first"), listed.alias("keywords"))


@query("a20_gap_ranking", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, gap, days_since, n_hooks, priority, hook, damp, score,
       row_number() OVER (PARTITION BY issue_date ORDER BY score DESC, priority DESC, gap) AS position
FROM (SELECT issue_date, gap, since AS days_since, n_hooks, round(p, 3) AS priority, round(hk, 3) AS hook, round(dp, 3) AS damp, round(p * (1 + hk) * dp, 3) AS score
  FROM (SELECT g.issue_date, g.gap, CAST(g.issue_date - last_taught AS INTEGER) AS since, coalesce(n, 0) AS n_hooks, greatest(0, target - now) * weight AS p,
               1 - exp(-coalesce(h, 0)) AS hk, coalesce(1 - exp(-(g.issue_date - last_taught) / CAST(4 AS DOUBLE)), 1) AS dp
        FROM gap_days g JOIN gap_list USING (gap)
        LEFT JOIN (SELECT issue_date, gap, sum(weight) AS h, count(*) AS n FROM gap_hits GROUP BY ALL) m ON m.issue_date = g.issue_date AND m.gap = g.gap))
""")
def gap_ranking(spark: SparkSession, sf: str) -> DataFrame:
    matches = _matches(spark, sf)
    return day(learn.rank_gaps(matches, b.headlines(spark, sf).select("issue_date"), lessons(spark, sf), GAPS, b.SETTINGS)).drop("label")


@query("a20_hook_stories", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, gap, id, rn FROM (SELECT *, row_number() OVER (PARTITION BY issue_date, gap ORDER BY weight DESC, id) AS rn FROM gap_hits) WHERE rn <= 3
""")
def hook_stories(spark: SparkSession, sf: str) -> DataFrame:
    return day(learn.hook_stories(_matches(spark, sf)).select("issue_date", "gap", "id", F.col("rn").cast("bigint").alias("rn")))


@query("o6_gap_order", """
SELECT gap, row_number() OVER (ORDER BY greatest(0, target - now) * weight DESC, gap) AS position, n FROM gap_list JOIN (SELECT gap, count(*) AS n FROM lessons GROUP BY gap) USING (gap)
""")
def gap_order(spark: SparkSession, sf: str) -> DataFrame:
    """Taught gaps by priority, with how often each was taught."""
    from pyspark.sql import Window

    from ..config import gap_dimension

    n = lessons(spark, sf).groupBy("gap").agg(F.count(F.lit(1)).alias("n"))
    p = scores.gap_priority(F.col("now"), F.col("target"), F.col("weight"))
    rows = gap_dimension(spark, GAPS).join(n, "gap")
    return rows.select("gap", F.row_number().over(Window.orderBy(p.desc(), "gap")).cast("bigint").alias("position"), "n")


@query("a21_last_taught", "SELECT CAST(issue_date AS VARCHAR) AS issue_date, gap, CAST(last_taught AS VARCHAR) AS last_taught FROM gap_days")
def last_taught(spark: SparkSession, sf: str) -> DataFrame:
    rows = learn.last_taught(lessons(spark, sf), b.headlines(spark, sf).select("issue_date"), GAPS)
    return day(rows, "issue_date", "last_taught")


@query("a22_tracker", """
SELECT gap, label, round(greatest(0, target - now) * weight, 3) AS priority, coalesce(n, 0) AS n, CAST(coalesce(minutes, 0) AS BIGINT) AS minutes, CAST(last AS VARCHAR) AS last
FROM gap_list LEFT JOIN (SELECT gap, count(*) AS n, sum(minutes) AS minutes, max(issue_date) AS last FROM lessons
     WHERE issue_date BETWEEN (SELECT max(issue_date) FROM headlines) - 29 AND (SELECT max(issue_date) FROM headlines) GROUP BY gap) USING (gap)
""")
def tracker(spark: SparkSession, sf: str) -> DataFrame:
    as_of = b.headlines(spark, sf).agg(F.max("issue_date")).first()[0]
    rows = learn.tracker(lessons(spark, sf), GAPS, F.lit(as_of), b.SETTINGS)
    return day(rows.select("gap", "label", "priority", "n", "minutes", "last"), "last")


@query("w9_streak", """
WITH d AS (SELECT h.issue_date, count(l.doc_id) AS n FROM headlines h LEFT JOIN lessons l ON l.doc_id = h.id GROUP BY h.issue_date),
i AS (SELECT *, count(*) FILTER (WHERE n = 0) OVER (ORDER BY issue_date) AS island FROM d)
SELECT CAST(issue_date AS VARCHAR) AS issue_date, count(*) FILTER (WHERE n > 0) OVER (PARTITION BY island ORDER BY issue_date) AS streak FROM i
""")
def streak(spark: SparkSession, sf: str) -> DataFrame:
    taught = lessons(spark, sf).select("id", F.lit(1).alias("one"))
    per_day = b.headlines(spark, sf).select("id", "issue_date").join(taught, "id", "left").groupBy("issue_date").agg(F.count("one").alias("n_lessons"))
    return day(learn.streaks(per_day))


@query("f17_gap_priority", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, round(greatest(0, l_tax * 100 - l_discount * 100) * l_quantity, 4) AS priority FROM lineitem
""")
def gap_priority(spark: SparkSession, sf: str) -> DataFrame:
    p = scores.gap_priority(F.col("l_discount") * 100, F.col("l_tax") * 100, F.col("l_quantity"))
    return b.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", F.round(p, 4).alias("priority"))


@query("f18_hook_and_damping", """
SELECT event_id, round(1 - exp(-value / CAST(100 AS DOUBLE)), 6) AS hook, round(coalesce(1 - exp(-CASE WHEN event_id % 7 > 0 THEN event_id % 7 END / CAST(4 AS DOUBLE)), 1), 6) AS damp FROM events
""")
def hook_and_damping(spark: SparkSession, sf: str) -> DataFrame:
    days = F.when(F.col("event_id") % 7 > 0, F.col("event_id") % 7)
    return b.table(spark, sf, "events").select(
        "event_id", F.round(scores.hook(F.col("value") / F.lit(100.0)), 6).alias("hook"), F.round(scores.damping(days), 6).alias("damp")
    )


# ---- calibration -------------------------------------------------------------------------------
_W = {"impact": 0.35, "novelty": 0.20, "credibility": 0.20, "breadth": 0.15, "momentum": 0.10}


@query("a23_calibration", " UNION ALL ".join(
    f"SELECT '{k}' AS component, count(*) AS n, round(avg({k}), 6) AS mean, round(stddev_pop({k}), 6) AS sd, "
    f"round(var_pop({100 * w} * {k}) / nullif(var_pop(total), 0), 6) AS variance_share, stddev_pop({k}) < 0.08 AS near_constant FROM scored_week"
    for k, w in _W.items()
))
def component_spread(spark: SparkSession, sf: str) -> DataFrame:
    return calibration.component_spread(b.scored(spark, sf), b.SETTINGS)


@query("a23_correlations", " UNION ALL ".join(
    f"SELECT '{x}' AS a, '{y}' AS b, round(corr({x}, {y}), 6) AS r, abs(corr({x}, {y})) > 0.8 AS redundant FROM scored_week"
    for i, x in enumerate(_W) for y in list(_W)[i + 1:]
))
def correlations(spark: SparkSession, sf: str) -> DataFrame:
    return calibration.correlations(b.scored(spark, sf))


@query("a23_calibration_last_issues", " UNION ALL ".join(
    f"SELECT '{k}' AS component, count(*) AS n, round(avg({k}), 6) AS mean, round(stddev_pop({k}), 6) AS sd, "
    f"round(var_pop({100 * w} * {k}) / nullif(var_pop(total), 0), 6) AS variance_share, stddev_pop({k}) < 0.08 AS near_constant "
    f"FROM scored_week WHERE issue_date IN (SELECT DISTINCT issue_date FROM scored_week ORDER BY issue_date DESC LIMIT 14)"
    for k, w in _W.items()
))
def last_issues(spark: SparkSession, sf: str) -> DataFrame:
    scored = b.scored(spark, sf)
    return calibration.component_spread(calibration.last_issues(scored, 14), b.SETTINGS)
