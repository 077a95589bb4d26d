"""Orderings within groups that stay distributed when one group holds a large share of the rows.

* `top_in_group` filters a `row_number`, which Spark prunes to k rows per group and map task
  before the shuffle, so a hot group costs k rows per task.
* `rank_in_group` gives every row its position. A plain window would sort a hot group in one task;
  here rows are dealt into ranges of the order, ranges are counted, and only rows of a range are
  sorted together.
* `running_min` is the same idea for a minimum over all earlier rows of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

BLOCK = 1 << 20


def top_in_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, out: str = "rn") -> DataFrame:
    """The first `k` rows of every group with their position in `out`."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def rank_in_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[tuple[str, bool]],
    tie: str,
    out: str = "rank",
    parts: int | None = None,
) -> DataFrame:
    """Position (1..n) of every row in its group, ordered by `order`, (column, ascending) pairs, and then by `tie`.

    Rows are dealt into ranges of (group, order, tie) and stored, so a hot group is split by its own order. Position =
    rows of the group in earlier ranges, from the small (range, group) counts, + position in the range. `parts` is the
    number of ranges (default: the session's shuffle partitions)."""
    rank_range, before, inside = "__range", "__before", "__inside"
    keys = [F.col(c).asc() if up else F.col(c).desc() for c, up in [*order, (tie, True)]]
    dealt = df.repartitionByRange(*([parts] if parts else []), *[F.col(g) for g in group], *keys)
    rows = stored(dealt.withColumn(rank_range, F.spark_partition_id()), "ranges")
    counts = rows.groupBy(*group, rank_range).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*group).orderBy(rank_range).rowsBetween(Window.unboundedPreceding, -1)
    names = [f"__group{i}" for i in range(len(group))]
    offsets = counts.select(
        *[F.col(g).alias(n) for g, n in zip(group, names, strict=True)], F.col(rank_range).alias("__of"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(before)
    ).filter(F.col(before) > 0)
    placed = rows.withColumn(inside, F.row_number().over(Window.partitionBy(*group, rank_range).orderBy(*keys)))
    same = [F.col(g).eqNullSafe(F.col(n)) for g, n in zip(group, names, strict=True)] + [F.col(rank_range) == F.col("__of")]
    joined = placed.join(offsets, same, "left")
    return joined.withColumn(out, (F.coalesce(F.col(before), F.lit(0)) + F.col(inside)).cast("bigint")).drop(*names, "__of", before, inside, rank_range)


def running_min(
    df: DataFrame, group: Sequence[str], position: str, value: str, out: str, block: int = BLOCK
) -> DataFrame:
    """Minimum of `value` over all rows of the group with a smaller `position` (null for the first).

    `position` is an integer unique within the group; blocks of it are reduced to their minimum, so
    the windows run over block minima and over single blocks only."""
    blk = "__blk"
    keyed = df.withColumn(blk, F.floor(F.col(position) / F.lit(block)))
    before = Window.partitionBy(*group).orderBy(blk).rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        keyed.groupBy(*group, blk).agg(F.min(value).alias("__block_min"))
        .withColumn("__before", F.min("__block_min").over(before))
        .drop("__block_min")
    )
    inside = Window.partitionBy(*group, blk).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    return (
        keyed.join(blocks, [*group, blk])
        .withColumn(out, F.least(F.col("__before"), F.min(value).over(inside)))
        .drop("__before", blk)
    )
