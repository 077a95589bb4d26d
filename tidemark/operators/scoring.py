"""Importance scores: source profile, mentions, baseline, weighted total.

Tables used throughout:
  items          id, issue_date, entity (primary, canonical), impact, novelty, coverage, ...
  sources        item_id, domain, tier, lang, ...
  item_entities  id, issue_date, entity, pos (0 = primary), canonical
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import COMPONENTS, Settings
from ..functions import scores

DEFAULT = Settings()


def canonical_entity(name: Column, aliases: Mapping[str, str]) -> Column:
    """Alias lookup on the trimmed lower-case name, else the trimmed name. The alias map is
    configuration, so it is a literal of the plan and needs no join."""
    name = F.trim(name)
    if not aliases:
        return name
    table = F.create_map(*[F.lit(x) for k, v in aliases.items() for x in (k.lower(), v)])
    return F.coalesce(F.try_element_at(table, F.lower(name)), name)


def canonical_entities(names: Column, aliases: Mapping[str, str]) -> Column:
    """Canonical names of an array, each once, order kept (element 0 stays the primary entity)."""
    return F.array_distinct(F.transform(names, lambda n: canonical_entity(n, aliases)))


def reliability_of(tier: Column, reliability: Mapping[str, float]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in reliability.items() for x in kv]), tier)


def source_profile(sources: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Per item: credibility (noisy-OR of the most reliable distinct domains), n_domains, verified.

    Reliabilities come from a short list of tiers, so the best `top_n` of an item follow from how many
    domains it has per level. Two hash aggregations with map-side combine, no sort, no collected group:
    an item with very many sources is as cheap as any other."""
    best = sources.groupBy("item_id", "domain").agg(
        F.max(reliability_of(F.col("tier"), settings.reliability)).alias("r"),
        F.max(F.col("tier") != "social").alias("independent"),
        F.max(F.col("tier") == "primary").alias("is_primary"),
    )
    levels = sorted(set(settings.reliability.values()), reverse=True)
    per_item = best.groupBy("item_id").agg(
        *[F.count_if(F.col("r") == F.lit(r)).alias(f"n{i}") for i, r in enumerate(levels)],
        F.count(F.lit(1)).alias("n_domains"),
        F.count_if("independent").alias("n_independent"),
        F.max("is_primary").alias("has_primary"),
    )
    miss = F.lit(1.0)
    for rank in range(1, settings.credibility_top_n + 1):
        seen, value = F.lit(0), None
        for i, r in enumerate(levels):
            seen = seen + F.col(f"n{i}")
            value = F.when(seen >= rank, F.lit(r)) if value is None else value.when(seen >= rank, F.lit(r))
        miss = miss * (F.lit(1.0) - value.otherwise(F.lit(0.0)))
    return per_item.select(
        "item_id",
        (F.lit(1.0) - miss).alias("credibility"),
        "n_domains",
        (F.col("has_primary") | (F.col("n_independent") >= settings.min_independent)).alias("verified"),
    )


def entity_mentions(item_entities: DataFrame) -> DataFrame:
    """Items per (issue_date, entity) that name the entity anywhere, ignoring case."""
    return item_entities.groupBy("issue_date", F.lower("entity").alias("entity_key")).agg(
        F.countDistinct("id").alias("mentions")
    )


def archived_days_before(dates: DataFrame, days: int) -> DataFrame:
    """For each date d: archived dates in [d - days, d - 1]. `dates` has distinct issue_date rows.

    Each date adds one to the `days` dates after it, so no window over the whole calendar is needed."""
    later = dates.select(F.explode(F.sequence(F.date_add("issue_date", 1), F.date_add("issue_date", days))).alias("issue_date"))
    return later.groupBy("issue_date").agg(F.count(F.lit(1)).alias("archived_days"))


def trailing_sum(counts: DataFrame, key: str, day: str, value: str, days: int, out: str = "past") -> DataFrame:
    """Sum of `value` over the previous `days` days, today excluded. One row per (key, day), so a
    window never holds more rows than there are dates."""
    frame = Window.partitionBy(key).orderBy(F.unix_date(day)).rangeBetween(-days, -1)
    return counts.withColumn(out, F.coalesce(F.sum(value).over(frame), F.lit(0)))


def history_mentions(item_entities: DataFrame, days: int) -> DataFrame:
    """(issue_date, entity_key, past_mentions) for every entity and date with an item."""
    counts = entity_mentions(item_entities)
    return trailing_sum(counts, "entity_key", "issue_date", "mentions", days, "past_mentions").drop("mentions")


def mentions_with_baseline(item_entities: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(issue_date, entity_key, mentions, baseline): the baseline is the entity's mean mentions per
    archived day of the previous days; missing days are skipped, archived days without it count as 0."""
    counts = entity_mentions(item_entities)
    archived = archived_days_before(item_entities.select("issue_date").distinct(), settings.baseline_days)
    return (
        trailing_sum(counts, "entity_key", "issue_date", "mentions", settings.baseline_days)
        .join(archived, "issue_date", "left")
        .select(
            "issue_date", "entity_key", "mentions",
            F.coalesce(F.try_divide(F.col("past"), F.col("archived_days")), F.lit(0.0)).alias("baseline"),
        )
    )


def score(items: DataFrame, sources: DataFrame, item_entities: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Items with coverage, mentions, baseline, verified, the five components and the total.

    Items without sources are dropped: they cannot be scored (see the data-quality rules)."""
    profile = source_profile(sources, settings).withColumnRenamed("item_id", "id")
    context = mentions_with_baseline(item_entities, settings).withColumnRenamed("mentions", "m")
    joined = (
        items.withColumn("entity_key", F.lower("entity"))
        .join(profile, "id")
        .join(context, ["issue_date", "entity_key"], "left")
        .withColumn("coverage", F.greatest(F.coalesce(F.col("coverage"), F.lit(0)), F.col("n_domains")).cast("int"))
        .withColumn("mentions", F.greatest(F.lit(1), F.coalesce("m", F.lit(1))).cast("int"))
        .withColumn("baseline", F.coalesce("baseline", F.lit(0.0)))
    )
    parts = {
        "impact": F.col("impact").cast("double"),
        "novelty": F.col("novelty").cast("double"),
        "credibility": F.col("credibility"),
        "breadth": scores.breadth(F.col("coverage"), settings.breadth_kappa),
        "momentum": scores.momentum(F.col("mentions"), F.col("baseline")),
    }
    total = F.round(scores.importance(parts, settings.weights), 1)
    rounded = {k: F.round(parts[k], 3) for k in COMPONENTS}
    return (
        joined.withColumns({"total": total, **{f"s_{k}": v for k, v in rounded.items()}})
        .withColumn("baseline", F.round("baseline", 3))
        .drop("m", "n_domains", "impact", "novelty", "credibility", "entity_key")
        .withColumnsRenamed({f"s_{k}": k for k in COMPONENTS})
    )


def score_struct() -> Column:
    """The flat score columns packed the way the archive stores them."""
    return F.struct(
        "total",
        F.struct(*COMPONENTS).alias("components"),
        "coverage", "mentions", "baseline", "verified",
    ).alias("score")
