"""Calibration of the score: spread of each component and correlation of each pair. One aggregation each."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COMPONENTS, Settings

DEFAULT = Settings()
MIN_ITEMS = 3


def last_issues(scored: DataFrame, n: int) -> DataFrame:
    """Items of the last `n` issues."""
    dates = scored.select("issue_date").distinct().orderBy(F.col("issue_date").desc()).limit(n)
    return scored.join(dates, "issue_date", "left_semi")


def _long(stats: DataFrame, rows: list[Column]) -> DataFrame:
    return stats.select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def component_spread(scored: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """component, n, mean, sd, its share in the variance of the total, near_constant. Empty below three items."""
    aggs = [F.count(F.lit(1)).alias("n"), F.var_pop("total").alias("v")]
    for k in COMPONENTS:
        aggs += [
            F.avg(k).alias(f"{k}_mean"), F.stddev_pop(k).alias(f"{k}_sd"),
            F.var_pop(F.lit(100 * settings.weights[k]) * F.col(k)).alias(f"{k}_var"),
        ]
    rows = [
        F.struct(
            F.lit(k).alias("component"), F.col("n"), F.round(f"{k}_mean", 6).alias("mean"), F.round(f"{k}_sd", 6).alias("sd"),
            F.round(F.try_divide(F.col(f"{k}_var"), F.col("v")), 6).alias("variance_share"), (F.col(f"{k}_sd") < 0.08).alias("near_constant"),
        )
        for k in COMPONENTS
    ]
    return _long(scored.agg(*aggs).filter(F.col("n") >= MIN_ITEMS), rows)


def correlations(scored: DataFrame) -> DataFrame:
    """Pearson r of all component pairs; |r| > 0.8 is redundant, null when one is constant."""
    pairs = list(combinations(COMPONENTS, 2))
    aggs = [F.corr(x, y).alias(f"{x}_{y}") for x, y in pairs]
    rows = [
        F.struct(
            F.lit(x).alias("a"), F.lit(y).alias("b"), F.round(f"{x}_{y}", 6).alias("r"), (F.abs(f"{x}_{y}") > 0.8).alias("redundant")
        )
        for x, y in pairs
    ]
    return _long(scored.agg(F.count(F.lit(1)).alias("n"), *aggs).filter(F.col("n") >= MIN_ITEMS), rows)
