"""Leads, briefs, the regional quota and the final rank of every issue.

Only a bounded number of items per issue can be shown, so the candidates are cut out first with
top-k windows (pruned before the shuffle), all placement rules run on the candidates, and the rest of
the issue is "noted". Only the final rank looks at every item, through `rank_in_group`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..session import cut
from .ranking import rank_in_group, top_in_group

DEFAULT = Settings()


def rank_order(*first: Column) -> list[Column]:
    """Highest total, then highest credibility, then smallest id (on the rounded values)."""
    return [*first, F.col("total").desc(), F.col("credibility").desc(), F.col("id").asc()]


def ranked(scored: DataFrame, parts: int | None = None) -> DataFrame:
    """Every item with its position in the issue by total, credibility and id."""
    return rank_in_group(scored, ["issue_date"], [("total", False), ("credibility", False)], "id", "rank", parts)


def leads(scored: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The first verified items of each issue with at most `max_leads_per_entity` per primary entity.

    Taking items greedily in rank order equals: keep the first few of each entity, then the first of
    those."""
    per_entity = top_in_group(
        scored.filter("verified").withColumn("entity_key", F.lower("entity")),
        ["issue_date", "entity_key"], rank_order(), settings.max_leads_per_entity, "entity_rn",
    )
    return top_in_group(per_entity, ["issue_date"], rank_order(), settings.leads, "lead_rn").drop("entity_rn", "entity_key")


def candidates(scored: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(issue_date, id) of everything that can be shown: the leads, the top of the issue (all briefs
    come from it), and the best of the quota region."""
    shown = settings.leads + settings.briefs
    regional = scored.filter(F.col("region") == settings.quota_region)
    keys = ["issue_date", "id"]
    pool = top_in_group(
        regional, ["issue_date"], rank_order(F.col("verified").desc()), shown + settings.region_quota
    ).select(*keys)
    top = top_in_group(scored, ["issue_date"], rank_order(), shown).select(*keys)
    lead = leads(scored, settings).select(*keys)
    return pool.union(top).union(lead).distinct()


def place_shown(scored: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The shown items of each issue: issue_date, id, placement, quota, rank."""
    cand = scored.select("issue_date", "id", "entity", "region", "total", "credibility", "verified").join(
        candidates(scored, settings), ["issue_date", "id"], "left_semi"
    )
    lead = leads(cand, settings).select("issue_date", "id", F.lit(True).alias("is_lead"))
    flagged = cand.join(lead, ["issue_date", "id"], "left").withColumn("is_lead", F.coalesce("is_lead", F.lit(False)))

    # From here on every window is over one issue's candidates, a bounded number of rows.
    issue = Window.partitionBy("issue_date")
    rest = Window.partitionBy("issue_date", "is_lead").orderBy(*rank_order())
    placed = flagged.withColumn(
        "placement",
        F.when(F.col("is_lead"), "lead")
        .when(F.row_number().over(rest) <= settings.briefs, "brief")
        .otherwise("noted"),
    )
    home = F.col("region") == settings.quota_region
    in_pool = home & (F.col("placement") == "noted")
    victim = ~home & (F.col("placement") == "brief")
    by_pool = Window.partitionBy("issue_date", in_pool).orderBy(*rank_order(F.col("verified").desc()))
    by_victim = Window.partitionBy("issue_date", victim).orderBy(
        F.col("total").asc(), F.col("credibility").asc(), F.col("id").desc()
    )
    counted = placed.select(
        "*",
        F.when(in_pool, F.row_number().over(by_pool)).alias("pool_k"),
        F.when(victim, F.row_number().over(by_victim)).alias("victim_k"),
        F.least(
            F.lit(settings.region_quota) - F.count_if(home & (F.col("placement") != "noted")).over(issue),
            F.count_if(in_pool).over(issue),
            F.count_if(victim).over(issue),
        ).alias("swaps"),
    )
    swapped = counted.select(
        "issue_date", "id", "total", "credibility",
        F.when(F.col("pool_k") <= F.col("swaps"), "brief")
        .when(F.col("victim_k") <= F.col("swaps"), "noted")
        .otherwise(F.col("placement")).alias("placement"),
        F.when(F.col("pool_k") <= F.col("swaps"), F.lit(settings.quota_region)).alias("quota"),
    ).filter(F.col("placement") != "noted")
    final = Window.partitionBy("issue_date").orderBy(*rank_order((F.col("placement") == "lead").desc()))
    return swapped.withColumn("rank", F.row_number().over(final).cast("bigint")).drop("total", "credibility")


def place(scored: DataFrame, settings: Settings = DEFAULT, parts: int | None = None, materialise: bool = True) -> DataFrame:
    """Every scored item with placement, quota mark and rank (1..n within its issue).

    The scored items feed several branches, so they are written to shared storage once."""
    if materialise:
        scored = cut(scored)
    shown = place_shown(scored, settings)
    n_shown = shown.groupBy("issue_date").agg(F.max("rank").alias("n_shown"))
    keys = ["issue_date", "id"]
    noted = rank_in_group(
        scored.join(shown.select(*keys), keys, "left_anti"),
        ["issue_date"], [("total", False), ("credibility", False)], "id", "noted_rank", parts,
    ).join(n_shown, "issue_date", "left")
    top = scored.join(shown, keys)
    return top.unionByName(
        noted.withColumns({
            "placement": F.lit("noted"),
            "quota": F.lit(None).cast("string"),
            "rank": F.col("noted_rank") + F.coalesce("n_shown", F.lit(0)),
        }).drop("noted_rank", "n_shown")
    )
