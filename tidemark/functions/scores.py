"""Score curves as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def breadth(coverage: Column, kappa: float = 6.0) -> Column:
    return F.lit(1.0) - F.exp(-coverage / F.lit(kappa))


def momentum(mentions: Column, baseline: Column) -> Column:
    return F.lit(1.0) - F.exp(-mentions / (baseline + F.lit(1.0)))


def importance(components: Mapping[str, Column], weights: Mapping[str, float]) -> Column:
    """100 times the weighted sum, in the order of `weights`."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.lit(weight) * components[name]
    return F.lit(100.0) * total


def gap_priority(now: Column, target: Column, weight: Column) -> Column:
    return F.greatest(F.lit(0.0), target - now) * weight


def hook(weight_sum: Column) -> Column:
    return F.lit(1.0) - F.exp(-weight_sum)


def damping(days_since: Column, tau: float = 4.0) -> Column:
    """1 when never taught, else growing back with the days since."""
    return F.coalesce(F.lit(1.0) - F.exp(-days_since / F.lit(tau)), F.lit(1.0))
