"""Single-link headline clusters: similar token sets, connected components, roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import TIERS
from ..session import stored
from .components import connected_components
from .forest import similar_forest
from .ranking import rank_in_group, top_in_group
from .similarity import HOT_TOKEN, distinct_sets, set_members


def headline_clusters(items: DataFrame, tokens: Column, threshold: float = 0.4, hot: int = HOT_TOKEN) -> DataFrame:
    """Items with their `component`, the smallest id of the cluster. Exact copies are joined through
    their common token set; items without tokens stay alone. Only a forest of the similar sets is made. Titles are read for
    their tokens once."""
    keyed = stored(items.withColumn("__tokens", F.array_sort(tokens)), "keyed")
    sets = stored(distinct_sets(keyed, "id", F.col("__tokens")), "sets")
    comp = connected_components(similar_forest(sets, threshold, hot), "set_a", "set_b")
    return (
        set_members(keyed, "id", F.col("__tokens"), sets)
        .join(comp.withColumnRenamed("node", "set_id"), "set_id", "left")
        .withColumn("component", F.coalesce("component", "set_id", "id"))
        .drop("set_id", "__tokens")
    )


def roll_up(members: DataFrame) -> DataFrame:
    """One row per cluster: best link (most reliable tier, direct before aggregator, earliest), number of outlets,
    size, first seen, best signals. Outlets and members stay rows (`cluster_outlets`, `members`); no list is collected.

    members: component, id, title, url, lang, outlet, tier, via, published_at, hn_points, hf_upvotes."""
    tier_rank = F.array_position(F.array(*[F.lit(t) for t in TIERS]), F.col("tier"))
    best = F.struct(tier_rank, F.col("via") == "gnews", "published_at", "id")
    return (
        members.groupBy("component")
        .agg(
            F.min_by(F.struct("id", "title", "url", "lang"), best).alias("best"),
            F.count_distinct("outlet").alias("n_outlets"),
            F.count(F.lit(1)).alias("n_items"),
            F.min("published_at").alias("first_seen"),
            F.coalesce(F.max("hn_points"), F.lit(0)).alias("hn_points"),
            F.coalesce(F.max("hf_upvotes"), F.lit(0)).alias("hf_upvotes"),
        )
        .select(
            "component", F.col("best.id").alias("best_id"), "best.title", "best.url", "best.lang",
            "n_outlets", "n_items", "first_seen", "hn_points", "hf_upvotes",
        )
    )


def cluster_outlets(members: DataFrame) -> DataFrame:
    """(component, outlet, n_items): the outlets of every cluster."""
    return members.filter("outlet is not null").groupBy("component", "outlet").agg(F.count(F.lit(1)).alias("n_items"))


def placed_members(members: DataFrame, parts: int | None = None) -> DataFrame:
    """Members with their `position` in the cluster, by (published_at, id)."""
    return rank_in_group(members, ["component"], [("published_at", True)], "id", "position", parts)


def cluster_order() -> list[Column]:
    return [F.col("n_outlets").desc(), F.col("hn_points").desc(), F.col("first_seen").asc(), F.col("title").asc(), F.col("component").asc()]


def top_clusters(clusters: DataFrame, per_lang: dict[str, int]) -> DataFrame:
    """The first clusters of each language, each with its position."""
    limit = F.create_map(*[F.lit(x) for kv in per_lang.items() for x in kv])
    some = clusters.filter(F.col("lang").isin(*per_lang))
    return top_in_group(some, ["lang"], cluster_order(), max(per_lang.values())).filter(F.col("rn") <= limit[F.col("lang")])
