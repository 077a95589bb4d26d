"""Views over scored and placed items: counts, leaderboards, rolling week, recap, trend, windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times
from ..operators import placement, views
from ..operators.ranking import rank_in_group
from ..session import cut, stored
from . import bindings as b
from .registry import cte, query

_T = {"t_urgent": "1-URGENT", "t_high": "2-HIGH", "t_medium": "3-MEDIUM", "t_none": "4-NOT SPECIFIED", "t_low": "5-LOW"}


def topic_columns(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({v: k for k, v in _T.items()})


def topic_sql(agg: str = "count(*)") -> str:
    return ", ".join(f"CAST({agg} FILTER (WHERE topic = '{v}') AS BIGINT) AS {k}" for k, v in _T.items())


def day(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: b.day_text(F.col(n)) for n in names or ("issue_date",)})


def sourced(spark: SparkSession, sf: str, unit: str = "day") -> DataFrame:
    lines = b.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("id"))
    return b.all_items(spark, sf, unit).join(lines, "id", "left_semi")


def placed_days(spark: SparkSession, sf: str) -> DataFrame:
    return cut(placement.place(b.scored(spark, sf, "day"), b.SETTINGS))


def entities(spark: SparkSession, sf: str) -> DataFrame:
    return b.item_entities(spark, sf, b.all_items(spark, sf, "day")).drop("issue_date")


@query("a6_topic_counts", f"SELECT CAST(day_date AS VARCHAR) AS issue_date, {topic_sql()} FROM items GROUP BY day_date")
def topic_counts(spark: SparkSession, sf: str) -> DataFrame:
    return day(topic_columns(views.counts_by(sourced(spark, sf), ["issue_date"], "topic", b.TOPICS)))


_LANG_SQL = ", ".join(f"CAST(count(*) FILTER (WHERE lang = '{v}') AS BIGINT) AS {v}" for v in b.LANGS)


@query("a7_language_split", f"SELECT item_id, {_LANG_SQL} FROM sources GROUP BY item_id")
def language_split(spark: SparkSession, sf: str) -> DataFrame:
    return views.counts_by(b.sources(spark, sf), ["item_id"], "lang", b.LANGS)


cte("named_week", """
SELECT s.issue_date, e.entity, CAST(s.total AS DECIMAL(6,1)) * CASE WHEN e.pos = 0 THEN 1.000 ELSE 0.250 END AS w
FROM item_entities e JOIN scored_day s ON s.id = e.id
""")


@query("a8_entity_leaderboard", """
SELECT week, entity, mentions, CAST(round(weight, 1) AS DOUBLE) AS weight, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY week ORDER BY weight DESC, mentions DESC, entity) AS rn
  FROM (SELECT strftime(issue_date, '%G-W%V') AS week, entity, count(*) AS mentions, sum(w) AS weight FROM named_week GROUP BY ALL)) WHERE rn <= 8
""")
def entity_leaderboard(spark: SparkSession, sf: str) -> DataFrame:
    weekly = b.scored(spark, sf, "day").withColumn("week", times.week_id(F.col("issue_date")))
    weights = views.entity_weights(weekly, entities(spark, sf), ["week"], b.SETTINGS)
    return views.entity_board(weights, ["week"], 8).withColumn("rn", F.col("rn").cast("bigint"))


cte("dates", "SELECT DISTINCT issue_date AS as_of FROM scored_day")
cte("week_pool", "SELECT d.as_of, p.* FROM dates d JOIN placed_day p ON p.issue_date BETWEEN d.as_of - 6 AND d.as_of")


@query("a9_rolling_week", f"""
SELECT CAST(as_of AS VARCHAR) AS as_of, count(DISTINCT issue_date) AS days, count(*) AS n, {topic_sql()} FROM week_pool GROUP BY as_of
""")
def rolling_week(spark: SparkSession, sf: str) -> DataFrame:
    return day(topic_columns(views.rolling_summary(sourced(spark, sf), b.TOPICS)), "as_of")


@query("a9_rolling_week_top", """
SELECT CAST(as_of AS VARCHAR) AS as_of, CAST(issue_date AS VARCHAR) AS issue_date, id, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY as_of ORDER BY total DESC, credibility DESC, id) AS rn
  FROM week_pool WHERE NOT (issue_date = as_of AND placement = 'lead')) WHERE rn <= 5
""")
def rolling_week_top(spark: SparkSession, sf: str) -> DataFrame:
    scored = stored(b.scored(spark, sf, "day").select("issue_date", "id", "entity", "total", "credibility", "verified"), "scored")
    rows = views.rolling_top(scored, placement.leads(scored, b.SETTINGS), b.SETTINGS).select("as_of", "issue_date", "id", F.col("rn").cast("bigint").alias("rn"))
    return day(rows, "as_of", "issue_date")


@query("a9_rolling_week_entities", """
SELECT CAST(as_of AS VARCHAR) AS as_of, entity, mentions, CAST(round(weight, 1) AS DOUBLE) AS weight, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY as_of ORDER BY weight DESC, mentions DESC, entity) AS rn
  FROM (SELECT as_of, entity, count(*) AS mentions, sum(w) AS weight FROM dates JOIN named_week ON issue_date BETWEEN as_of - 6 AND as_of GROUP BY ALL)) WHERE rn <= 6
""")
def rolling_week_entities(spark: SparkSession, sf: str) -> DataFrame:
    scored = stored(b.scored(spark, sf, "day").select("issue_date", "id", "total"), "scored")
    return day(views.rolling_entities(scored, entities(spark, sf), b.SETTINGS), "as_of").withColumn("rn", F.col("rn").cast("bigint"))


@query("o5_top_lists", """
SELECT week, CAST(issue_date AS VARCHAR) AS issue_date, id, rn FROM (
  SELECT strftime(issue_date, '%G-W%V') AS week, issue_date, id,
         row_number() OVER (PARTITION BY strftime(issue_date, '%G-W%V') ORDER BY total DESC, credibility DESC, id) AS rn FROM scored_day) WHERE rn <= 10
""")
def top_lists(spark: SparkSession, sf: str) -> DataFrame:
    rows = _recap(spark, sf)["top"].select("week", "issue_date", "id", F.col("rn").cast("bigint").alias("rn"))
    return day(rows)


_TREND_DAYS = 3000


@query("a10_trend", f"""
SELECT CAST(d AS VARCHAR) AS issue_date, {topic_sql('count(topic)')}, count(topic) = 0 AS missing
FROM (SELECT CAST(unnest(generate_series((SELECT greatest(min(day_date), max(day_date) - {_TREND_DAYS - 1}) FROM items), (SELECT max(day_date) FROM items), INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN items ON day_date = d GROUP BY d
""")
def trend(spark: SparkSession, sf: str) -> DataFrame:
    items = cut(sourced(spark, sf).select("issue_date", "topic"))
    archived = items.select("issue_date").distinct()
    end = archived.agg(F.max("issue_date")).first()[0]
    return day(topic_columns(views.trend(items, archived, F.lit(end), _TREND_DAYS, b.TOPICS)))


_EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query("a10_event_trend", f"""
SELECT CAST(d AS VARCHAR) AS issue_date, {", ".join(f"CAST(count(*) FILTER (WHERE event_type = '{t}') AS BIGINT) AS {t}" for t in _EVENT_TYPES)}, count(event_id) = 0 AS missing
FROM (SELECT CAST(unnest(generate_series((SELECT CAST(min(ts) AS DATE) FROM events), (SELECT CAST(max(ts) AS DATE) + 4 FROM events), INTERVAL 1 DAY)) AS DATE) AS d)
LEFT JOIN events ON CAST(ts AS DATE) = d GROUP BY d
""")
def event_trend(spark: SparkSession, sf: str) -> DataFrame:
    """All events per day and type, up to four days after the last one, so that missing days show."""
    rows = b.table(spark, sf, "events").select(F.to_date("ts").alias("issue_date"), F.col("event_type").alias("topic"))
    first, last = rows.agg(F.min("issue_date"), F.max("issue_date")).first()
    out = views.trend(rows, rows.select("issue_date").distinct(), F.date_add(F.lit(last), 4), (last - first).days + 5, _EVENT_TYPES)
    return day(out)


def _recap(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return views.weekly_recap(b.scored(spark, sf, "day"), entities(spark, sf), b.sources(spark, sf), b.TOPICS, b.LANGS, b.SETTINGS)


@query("a11_weekly_recap", f"""
SELECT r.*, en, zh, other FROM (SELECT strftime(issue_date, '%G-W%V') AS week, count(*) AS n, count(DISTINCT issue_date) AS issues, {topic_sql()} FROM scored_day GROUP BY ALL) r
JOIN (SELECT strftime(day_date, '%G-W%V') AS week, {_LANG_SQL} FROM sources JOIN items ON id = item_id GROUP BY ALL) l ON l.week = r.week
""")
def weekly_recap(spark: SparkSession, sf: str) -> DataFrame:
    recap = _recap(spark, sf)
    return topic_columns(recap["summary"].join(recap["langs"], "week"))


@query("a11_weekly_matrix", f"""
SELECT strftime(d, '%G-W%V') AS week, CAST(d AS VARCHAR) AS issue_date, count(topic) > 0 AS issue, {topic_sql('count(topic)')}
FROM (SELECT week_date + CAST(i AS INTEGER) AS d FROM (SELECT DISTINCT week_date FROM items), (SELECT unnest(generate_series(0, 6)) AS i)) LEFT JOIN items ON day_date = d GROUP BY d
""")
def weekly_matrix(spark: SparkSession, sf: str) -> DataFrame:
    items = sourced(spark, sf).withColumn("week", times.week_id(F.col("issue_date")))
    per_day = views.counts_by(items, ["week", "issue_date"], "topic", b.TOPICS)
    return day(topic_columns(views.week_matrix(per_day, b.TOPICS)))


@query("a11_weekly_rollup", """
SELECT week, topic, CAST(day_date AS VARCHAR) AS issue_date, count(*) AS n FROM (SELECT *, strftime(day_date, '%G-W%V') AS week FROM items) GROUP BY ROLLUP (week, topic, day_date)
""")
def weekly_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return day(views.topic_matrix_rollup(sourced(spark, sf)))


@query("a24_issue_summary", f"""
SELECT CAST(issue_date AS VARCHAR) AS issue_date, count(*) AS n, count(*) FILTER (WHERE placement = 'lead') AS leads, max(total) AS top_score, {topic_sql()}
FROM placed_week GROUP BY issue_date
""")
def issue_summary(spark: SparkSession, sf: str) -> DataFrame:
    placed = cut(placement.place(b.scored(spark, sf), b.SETTINGS))
    return day(topic_columns(views.issue_summary(placed, b.TOPICS)))


@query("f21_shares", """
SELECT item_id, round(en / CAST(nullif(en + zh + other, 0) AS DOUBLE), 6) AS en_share, round(zh / CAST(nullif(en + zh + other, 0) AS DOUBLE), 6) AS zh_share
FROM (SELECT item_id, count(*) FILTER (WHERE lang = 'en') AS en, count(*) FILTER (WHERE lang = 'zh') AS zh, count(*) FILTER (WHERE lang = 'other') AS other FROM sources GROUP BY item_id)
""")
def shares(spark: SparkSession, sf: str) -> DataFrame:
    counts = views.counts_by(b.sources(spark, sf), ["item_id"], "lang", b.LANGS)
    return views.shares(counts, b.LANGS).select("item_id", F.round("en_share", 6).alias("en_share"), F.round("zh_share", 6).alias("zh_share"))


# ---- projections and filters ----------------------------------------------------------------
cte("first_source", """
SELECT item_id, first('https://www.' || domain || '/' || part_key || '/?utm_source=feed' ORDER BY pos, part_key, supp_key) AS url,
       first(outlet ORDER BY pos, part_key, supp_key) AS outlet FROM sources GROUP BY item_id
""")


@query("p7_item_refs", """
SELECT id, CAST(issue_date AS VARCHAR) AS issue_date, topic, region, total AS score, url, outlet FROM scored_week JOIN first_source ON item_id = id
""")
def item_refs(spark: SparkSession, sf: str) -> DataFrame:
    first = views.display_source(b.sources(spark, sf), ["pos", "part_key", "supp_key"])
    return day(views.item_refs(b.scored(spark, sf), first))


@query("p8_scored_only", "SELECT id FROM scored_week")
def scored_only(spark: SparkSession, sf: str) -> DataFrame:
    totals = b.scored(spark, sf).select("id", "total")
    return b.all_items(spark, sf).select("id").join(totals, "id", "left").filter("total is not null").select("id")


@query("p5_region_desk", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, id, placement FROM placed_week WHERE region = 'ASIA' AND placement <> 'lead'
""")
def region_desk(spark: SparkSession, sf: str) -> DataFrame:
    placed = placement.place(b.scored(spark, sf), b.SETTINGS)
    return day(placed.filter("region = 'ASIA' AND placement <> 'lead'").select("issue_date", "id", "placement"))


@query("p10_placement_split", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, placement, count(*) AS n, count(*) FILTER (WHERE NOT verified) AS unverified FROM placed_week GROUP BY ALL
""")
def placement_split(spark: SparkSession, sf: str) -> DataFrame:
    placed = placement.place(b.scored(spark, sf), b.SETTINGS)
    return day(placed.groupBy("issue_date", "placement").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("verified")).alias("unverified")))


@query("p12_recent_items", """
SELECT CAST(w.week_date AS VARCHAR) AS issue_date, count(i.id) AS n, CAST(sum(i.id) AS BIGINT) AS id_sum
FROM (SELECT DISTINCT week_date FROM items) w JOIN items i ON i.day_date BETWEEN w.week_date - 7 AND w.week_date - 1 GROUP BY w.week_date
""")
def recent_items(spark: SparkSession, sf: str) -> DataFrame:
    """What the seven days before each Monday issue published."""
    items = sourced(spark, sf).groupBy("issue_date").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum"))
    mondays = sourced(spark, sf, "week").select(F.col("issue_date").alias("as_of")).distinct()
    later = items.withColumn("as_of", F.explode(F.sequence(F.date_add("issue_date", 1), F.date_add("issue_date", 7))))
    recent = later.join(mondays, "as_of", "left_semi").groupBy("as_of").agg(F.sum("n").alias("n"), F.sum("id_sum").alias("id_sum"))
    return day(recent.withColumnRenamed("as_of", "issue_date"))


@query("p3_window_membership", """
SELECT id, published_at BETWEEN week_date + INTERVAL 3 HOUR AND week_date + INTERVAL 120 HOUR AS inside,
       published_at BETWEEN week_date + INTERVAL 3 HOUR - INTERVAL 6 HOUR AND week_date + INTERVAL 120 HOUR AS graced FROM all_items
""")
def window_membership(spark: SparkSession, sf: str) -> DataFrame:
    start = F.col("issue_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(3))
    end = F.col("issue_date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(120))
    inside, graced = times.in_window(F.col("published_at"), start, end, b.SETTINGS.grace_hours)
    return b.all_items(spark, sf).select("id", inside.alias("inside"), graced.alias("graced"))


# ---- issue windows ------------------------------------------------------------------------------
cte("runs", """
SELECT day_date AS issue_date, CAST(day_date AS TIMESTAMP) + INTERVAL 22 HOUR + to_minutes(CAST(count(*) % 60 AS INTEGER)) AS window_end
FROM items GROUP BY day_date
""")
_WINDOW_SQL = """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, strftime(s, '%Y-%m-%dT%H:%M:%SZ') AS window_start, strftime(window_end, '%Y-%m-%dT%H:%M:%SZ') AS window_end,
       gap, round(epoch(window_end - s) / 3600.0, 6) AS hours, CAST(l AS VARCHAR) AS local_day, strftime(l, '%G-W%V') AS week, isodow(l) = 7 AS closes_week
FROM (SELECT *, coalesce(epoch(window_end - prev) / 3600.0 > 72, false) AS gap,
             CASE WHEN prev IS NULL THEN window_end - INTERVAL 24 HOUR WHEN epoch(window_end - prev) / 3600.0 > 72 THEN window_end - INTERVAL 72 HOUR ELSE prev END AS s,
             CAST(s + to_seconds(epoch(window_end - s) / 2) + INTERVAL 8 HOUR AS DATE) AS l
      FROM (SELECT *, lag(window_end) OVER (ORDER BY issue_date) AS prev FROM runs))
"""


def runs(spark: SparkSession, sf: str) -> DataFrame:
    """One run per archived day."""
    kept = sourced(spark, sf).groupBy("issue_date").agg((F.count(F.lit(1)) % 60).cast("int").alias("minute"))
    return kept.select(
        "issue_date",
        (F.col("issue_date").cast("timestamp") + F.make_dt_interval(hours=F.lit(22), mins=F.col("minute"))).alias("window_end"),
    )


def _window_columns(df: DataFrame) -> DataFrame:
    return day(df.withColumns({
        "window_start": times.fmt_ts(F.col("window_start")), "window_end": times.fmt_ts(F.col("window_end")), "hours": F.round("hours", 6),
    }), "issue_date", "local_day").select("issue_date", "window_start", "window_end", "gap", "hours", "local_day", "week", "closes_week")


@query("w10_issue_window", _WINDOW_SQL)
def issue_window(spark: SparkSession, sf: str) -> DataFrame:
    return _window_columns(views.issue_windows(runs(spark, sf), b.SETTINGS))


@query("f20_window_facts", _WINDOW_SQL)
def window_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Hours, midpoint day and Sunday test of windows given by their two ends."""
    from pyspark.sql import Window

    rows = runs(spark, sf).withColumn("previous_end", F.lag("window_end").over(Window.orderBy("issue_date")))
    return _window_columns(views.close_window(rows, b.SETTINGS))


@query("w10_next_window", """
SELECT strftime(max_by(window_end, issue_date), '%Y-%m-%dT%H:%M:%SZ') AS previous_end FROM runs WHERE window_end < TIMESTAMP '2000-06-15 06:00:00'
""")
def next_window(spark: SparkSession, sf: str) -> DataFrame:
    rows = views.next_window(runs(spark, sf), F.lit("2000-06-15 06:00:30").cast("timestamp"), b.SETTINGS)
    return rows.select(times.fmt_ts(F.col("previous_end")).alias("previous_end"))


# ---- themes ---------------------------------------------------------------------------------------
cte("theme_lists", """
SELECT week, theme, id, row_number() OVER (PARTITION BY week, theme ORDER BY first_line, id) - 1 AS pos
FROM (SELECT strftime(l_shipdate, '%G-W%V') AS week, l_returnflag AS theme, l_orderkey AS id, min(l_linenumber) AS first_line FROM lineitem GROUP BY ALL)
""")


def themes(spark: SparkSession, sf: str) -> DataFrame:
    """Orders shipped in a week with the same flag as a theme's items: week, theme, pos, id."""
    line = b.table(spark, sf, "lineitem").groupBy(
        times.week_id(F.to_date("l_shipdate")).alias("week"), F.col("l_returnflag").alias("theme"), F.col("l_orderkey").alias("id")
    ).agg(F.min("l_linenumber").alias("first_line"))
    placed = rank_in_group(cut(line), ["week", "theme"], [("first_line", True)], "id", "position")
    return placed.select("week", "theme", (F.col("position") - 1).alias("pos"), "id")


def _week_items(spark: SparkSession, sf: str) -> DataFrame:
    return sourced(spark, sf).select(times.week_id(F.col("issue_date")).alias("week"), "id", "topic")


@query("j10_theme_refs", """
SELECT t.week, theme, pos, t.id, topic FROM theme_lists t JOIN items i ON i.id = t.id AND strftime(day_date, '%G-W%V') = t.week
""")
def theme_refs(spark: SparkSession, sf: str) -> DataFrame:
    return views.theme_refs(themes(spark, sf), _week_items(spark, sf))


@query("v6_theme_references", """
SELECT t.week, theme, pos, t.id FROM theme_lists t WHERE NOT EXISTS (SELECT 1 FROM items i WHERE i.id = t.id AND strftime(day_date, '%G-W%V') = t.week)
""")
def theme_references(spark: SparkSession, sf: str) -> DataFrame:
    return views.unresolved_refs(themes(spark, sf), _week_items(spark, sf))
