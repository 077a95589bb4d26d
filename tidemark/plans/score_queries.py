"""Scores, placement and their parts, on orders as items and lineitems as sources."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as curves
from ..operators import placement, scoring
from ..session import cut
from . import bindings as b
from .registry import query


@query("a1_credibility", "SELECT item_id, round(credibility, 6) AS credibility FROM profile")
def credibility(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.source_profile(b.scored_sources(spark, sf), b.SETTINGS).select(
        "item_id", F.round("credibility", 6).alias("credibility")
    )


@query("a2_effective_coverage", """
SELECT id, CAST(greatest(coverage, n_domains) AS BIGINT) AS coverage FROM items JOIN profile ON item_id = id
""")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    profile = scoring.source_profile(b.scored_sources(spark, sf), b.SETTINGS)
    items = b.all_items(spark, sf).select(F.col("id").alias("item_id"), "coverage")
    return items.join(profile, "item_id").select(
        F.col("item_id").alias("id"), F.greatest(F.col("coverage"), F.col("n_domains")).cast("bigint").alias("coverage")
    )


@query("a3_mentions", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, lower(entity) AS entity_key, mentions FROM mentions_week
""")
def mentions(spark: SparkSession, sf: str) -> DataFrame:
    items = b.all_items(spark, sf)
    counts = scoring.entity_mentions(b.item_entities(spark, sf, items))
    return counts.select(b.day_text(F.col("issue_date")).alias("issue_date"), "entity_key", "mentions")


def _baseline(spark: SparkSession, sf: str) -> DataFrame:
    items = b.all_items(spark, sf, "day")
    return scoring.mentions_with_baseline(b.item_entities(spark, sf, items), b.SETTINGS)


@query("a4_baseline", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, lower(entity) AS entity_key, round(baseline, 6) AS baseline FROM baseline_day
""")
def baseline(spark: SparkSession, sf: str) -> DataFrame:
    return _baseline(spark, sf).select(
        b.day_text(F.col("issue_date")).alias("issue_date"), "entity_key", F.round("baseline", 6).alias("baseline")
    )


@query("j13_history_range_join", """
SELECT i.id, CAST(i.day_date AS VARCHAR) AS issue_date, lower(i.entity) AS entity_key, CAST(count(p.id) AS BIGINT) AS past_mentions
FROM items i LEFT JOIN (SELECT e.id, e.entity, d.day_date FROM item_entities e JOIN items d ON d.id = e.id) p
     ON p.entity = i.entity AND p.day_date BETWEEN i.day_date - 7 AND i.day_date - 1
GROUP BY ALL
""")
def history_range_join(spark: SparkSession, sf: str) -> DataFrame:
    items = b.all_items(spark, sf, "day")
    entities = b.item_entities(spark, sf, items)
    history = scoring.history_mentions(entities, b.SETTINGS.baseline_days)
    primary = entities.filter("pos = 0").select("id", "issue_date", F.lower("entity").alias("entity_key"))
    return primary.join(history, ["issue_date", "entity_key"], "left").select(
        "id", b.day_text(F.col("issue_date")).alias("issue_date"), "entity_key",
        F.coalesce("past_mentions", F.lit(0)).cast("bigint").alias("past_mentions"),
    )


@query("w8_trailing_frame", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, lower(entity) AS entity_key,
       CAST(coalesce(sum(mentions) OVER (PARTITION BY entity ORDER BY issue_date
            RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING), 0) AS BIGINT) AS past
FROM mentions_day
""")
def trailing_frame(spark: SparkSession, sf: str) -> DataFrame:
    items = b.all_items(spark, sf, "day")
    counts = scoring.entity_mentions(b.item_entities(spark, sf, items))
    return scoring.trailing_sum(counts, "entity_key", "issue_date", "mentions", b.SETTINGS.baseline_days).select(
        b.day_text(F.col("issue_date")).alias("issue_date"), "entity_key", F.col("past").cast("bigint").alias("past")
    )


_SCORE_COLUMNS = ("impact", "novelty", "credibility", "breadth", "momentum", "baseline", "total")


@query("a5_importance", """
SELECT id, CAST(issue_date AS VARCHAR) AS issue_date, impact, novelty, credibility, breadth, momentum, baseline, total,
       CAST(coverage AS BIGINT) AS coverage, CAST(mentions AS BIGINT) AS mentions, verified
FROM scored_week
""")
def importance(spark: SparkSession, sf: str) -> DataFrame:
    return b.scored(spark, sf).select(
        "id", b.day_text(F.col("issue_date")).alias("issue_date"), *_SCORE_COLUMNS,
        F.col("coverage").cast("bigint").alias("coverage"), F.col("mentions").cast("bigint").alias("mentions"), "verified",
    )


@query("p4_verified", "SELECT item_id, verified FROM profile")
def verified(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.source_profile(b.scored_sources(spark, sf), b.SETTINGS).select("item_id", "verified")


@query("f6_breadth", "SELECT id, round(1 - exp(-coverage / CAST(6 AS DOUBLE)), 6) AS breadth FROM all_items")
def breadth(spark: SparkSession, sf: str) -> DataFrame:
    return b.all_items(spark, sf).select("id", F.round(curves.breadth(F.col("coverage")), 6).alias("breadth"))


@query("f7_momentum", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, lower(entity) AS entity_key,
       round(1 - exp(-mentions / (baseline + 1)), 6) AS momentum FROM baseline_day
""")
def momentum(spark: SparkSession, sf: str) -> DataFrame:
    return _baseline(spark, sf).select(
        b.day_text(F.col("issue_date")).alias("issue_date"), "entity_key",
        F.round(curves.momentum(F.col("mentions"), F.col("baseline")), 6).alias("momentum"),
    )


@query("j17_tier_reliability", """
SELECT tier, lang, count(*) AS n, round(sum(CAST(CASE tier WHEN 'primary' THEN 0.60 WHEN 'press' THEN 0.45 WHEN 'trade' THEN 0.25
       ELSE 0.10 END AS DOUBLE)), 4) AS reliability_sum
FROM sources GROUP BY tier, lang
""")
def tier_reliability(spark: SparkSession, sf: str) -> DataFrame:
    rel = scoring.reliability_of(F.col("tier"), b.SETTINGS.reliability)
    return b.sources(spark, sf).groupBy("tier", "lang").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(rel), 4).alias("reliability_sum")
    )


def placed(spark: SparkSession, sf: str, unit: str = "week") -> DataFrame:
    return placement.place(b.scored(spark, sf, unit), b.SETTINGS)


@query("w2_rank_key", """
SELECT id, CAST(issue_date AS VARCHAR) AS issue_date,
       row_number() OVER (PARTITION BY issue_date ORDER BY total DESC, credibility DESC, id) AS rank
FROM scored_week
""")
def rank_key(spark: SparkSession, sf: str) -> DataFrame:
    rows = cut(b.scored(spark, sf).select("id", "issue_date", "total", "credibility"))
    return placement.ranked(rows).select(
        "id", b.day_text(F.col("issue_date")).alias("issue_date"), "rank"
    )


@query("w3_leads", "SELECT CAST(issue_date AS VARCHAR) AS issue_date, id FROM lead_week")
def leads(spark: SparkSession, sf: str) -> DataFrame:
    return placement.leads(b.scored(spark, sf), b.SETTINGS).select(b.day_text(F.col("issue_date")).alias("issue_date"), "id")


_REGION_LEADS = """
WITH per_region AS (
  SELECT *, row_number() OVER (PARTITION BY issue_date, region ORDER BY total DESC, credibility DESC, id) AS rn
  FROM scored_week WHERE verified)
SELECT CAST(issue_date AS VARCHAR) AS issue_date, id, lead_rn FROM (
  SELECT *, row_number() OVER (PARTITION BY issue_date ORDER BY total DESC, credibility DESC, id) AS lead_rn
  FROM per_region WHERE rn <= 2) WHERE lead_rn <= 5
"""


@query("w3_leads_by_region", _REGION_LEADS)
def leads_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """The diversity cap with the coarser region as the entity, so that it binds often."""
    rows = b.scored(spark, sf).withColumn("entity", F.col("region"))
    return placement.leads(rows, b.SETTINGS).select(
        b.day_text(F.col("issue_date")).alias("issue_date"), "id", F.col("lead_rn").cast("bigint").alias("lead_rn")
    )


@query("w4_briefs", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, first_placement AS placement, count(*) AS n, CAST(sum(id) AS BIGINT) AS id_sum
FROM first_week GROUP BY ALL
""")
def briefs(spark: SparkSession, sf: str) -> DataFrame:
    """Placement before the quota (a quota of 0)."""
    rows = placement.place(b.scored(spark, sf), replace(b.SETTINGS, region_quota=0))
    return rows.groupBy(b.day_text(F.col("issue_date")).alias("issue_date"), "placement").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("id_sum")
    )


@query("w5_quota_swap", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, id, first_placement AS before, placement AS after
FROM placed_week WHERE first_placement <> placement
""")
def quota_swap(spark: SparkSession, sf: str) -> DataFrame:
    scored = cut(b.scored(spark, sf))
    keys = ["issue_date", "id"]
    before = placement.place_shown(scored, replace(b.SETTINGS, region_quota=0)).select(*keys, F.col("placement").alias("before"))
    after = placement.place_shown(scored, b.SETTINGS).select(*keys, F.col("placement").alias("after"))
    noted = F.lit("noted")
    return (
        before.join(after, keys, "full_outer")
        .select("issue_date", "id", F.coalesce("before", noted).alias("before"), F.coalesce("after", noted).alias("after"))
        .filter("before <> after")
        .withColumn("issue_date", b.day_text(F.col("issue_date")))
    )


@query("w7_final_rank", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, id, placement, quota, rank FROM placed_week
""")
def final_rank(spark: SparkSession, sf: str) -> DataFrame:
    return placed(spark, sf).select(b.day_text(F.col("issue_date")).alias("issue_date"), "id", "placement", "quota", "rank")


@query("flagship_top_leads", """
SELECT CAST(issue_date AS VARCHAR) AS issue_date, rank, id, entity, topic, total, credibility
FROM placed_week WHERE placement = 'lead'
""")
def top_leads(spark: SparkSession, sf: str) -> DataFrame:
    """Lead stories of every issue, end to end: scan, score, choose. Leads come first in the final rank, so their place among
    themselves is their rank, and nothing else has to be placed."""
    return placement.leads(b.scored(spark, sf), b.SETTINGS).select(
        b.day_text(F.col("issue_date")).alias("issue_date"), F.col("lead_rn").cast("bigint").alias("rank"), "id", "entity", "topic", "total", "credibility"
    )
