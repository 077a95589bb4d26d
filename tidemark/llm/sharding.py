"""Sharding by a hypergeometric communication matrix (operator 6, SQL functions only; law `rows`).

A uniform random permutation that cuts N rows into shards of fixed sizes sends a random number of each input partition's
rows to each shard, and those numbers have a multivariate hypergeometric law. They are drawn first, exactly; then every
partition permutes its own rows, sends them out by its numbers, and every shard permutes what it got. Rows cross the
network once. Shard sizes differ by one row at most.

The matrix is drawn by halving: a node holds the sizes of a run of partitions and its number of rows for each shard; the
left half's numbers are hypergeometric given both. A draw inverts the distribution function from its mode, with the ratios
of neighbouring probabilities, over 10 standard deviations to each side. Only partition sizes are handled together.

Slots: a shard is cut by the second random key into parts of about `PART_ROWS` rows that are ordered on their own, so no
task holds a shard. A slot is the part's offset plus the place in the part.

Defined cases: null text has size 1 and a null checksum; null ids and repeated rows are rows like others; an empty table
gives none; fewer rows than shards leave shards empty. Clashing names (law, shard, slot, grown_shard) are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import shielded, stored

SHARDS = 8
SEED = 77
PART_ROWS = 8192
BROADCAST_ROWS = 100_000
#: Level of the halving from which its nodes are dealt over several tasks.
SPREAD_LEVEL = 6
_ADDED = ("law", "shard", "slot", "grown_shard")
_HELPERS = ("_key", "_at", "_block", "_place", "_part", "_offset", "_rank", "ends", "n")
_LOCAL = (1 << 33) - 1


def _uniform(*parts: Column) -> Column:
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") + 0.5) / float(1 << 53)


def _let(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(population: Column, good: Column, draws: Column, u: Column) -> Column:
    """Number of good ones among `draws` from `population`, by inversion at `u` in (0, 1)."""
    given = F.struct(*[x.cast("double").alias(k) for k, x in (("all", population), ("good", good), ("drawn", draws), ("u", u))])

    def bounds(g: Column) -> Column:
        low, high = F.greatest(F.lit(0.0), g["drawn"] + g["good"] - g["all"]), F.least(g["drawn"], g["good"])
        share = g["good"] / F.greatest(g["all"], F.lit(1.0))
        mode = F.least(F.greatest(F.floor((g["drawn"] + 1) * (g["good"] + 1) / (g["all"] + 2)).cast("double"), low), high)
        reach = F.ceil(10 * F.sqrt(F.greatest(g["drawn"] * share * (1 - share), F.lit(0.0))) + 30).cast("double")
        return F.struct(
            g["all"].alias("all"), g["good"].alias("good"), g["drawn"].alias("drawn"), g["u"].alias("u"), mode.alias("mode"),
            F.least(high - mode, reach).cast("int").alias("ups"), F.least(mode - low, reach).cast("int").alias("downs"),
        )

    def steps(count: Column) -> Column:
        return F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))

    def inverse(b: Column) -> Column:
        N, K, n, mode = b["all"], b["good"], b["drawn"], b["mode"]

        def up(w: Column, j: Column) -> Column:  # weight of mode + j from that of mode + j - 1
            k = mode + j - 1
            return w * (K - k) * (n - k) / ((k + 1) * (N - K - n + k + 1))

        def down(w: Column, j: Column) -> Column:
            k = mode - j + 1
            return w * k * (N - K - n + k) / ((K - k + 1) * (n - k + 1))

        def mass(count: Column, ratio) -> Column:
            def add(s: Column, j: Column) -> Column:
                return _let(ratio(s["w"], j), lambda w: F.struct(w.alias("w"), (s["sum"] + w).alias("sum")))

            return F.aggregate(steps(count), F.struct(F.lit(1.0).alias("w"), F.lit(0.0).alias("sum")), add, lambda s: s["sum"])

        def walk(count: Column, ratio, left: Column) -> Column:
            """Steps to where the mass `left` is used up."""
            start = F.struct(F.lit(1.0).alias("w"), left.alias("left"), F.lit(0).alias("at"))

            def go(s: Column, j: Column) -> Column:
                further = _let(ratio(s["w"], j), lambda w: F.struct(w.alias("w"), (s["left"] - w).alias("left"), j.alias("at")))
                return F.when(s["left"] <= 0, s).otherwise(further)

            return F.aggregate(steps(count), start, go, lambda s: s["at"])

        def choose(m: Column) -> Column:
            target = b["u"] * (1 + m["above"] + m["below"])
            upward = mode + walk(b["ups"], up, target - 1)
            downward = mode - walk(b["downs"], down, target - 1 - m["above"])
            return F.when(target <= 1, mode).when(target <= 1 + m["above"], upward).otherwise(downward)

        return _let(F.struct(mass(b["ups"], up).alias("above"), mass(b["downs"], down).alias("below")), choose)

    return _let(given, lambda g: _let(bounds(g), inverse)).cast("long")


def communication_matrix(sizes: DataFrame, shards: int, seed: int) -> DataFrame:
    """(block, ends): for each block of (block, n) the running totals of its rows per shard."""
    root = sizes.agg(F.array_sort(F.collect_list(F.struct("block", "n"))).alias("blocks")).filter(F.size("blocks") > 0)
    total = F.aggregate("blocks", F.lit(0).cast("long"), lambda a, b: a + b["n"])
    node = root.withColumn("total", total).withColumn(
        "rows", F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.floor(F.col("total") / shards) + (s < F.col("total") % shards).cast("long"))
    )
    blocks = sizes.count()
    for level in range(math.ceil(math.log2(blocks)) if blocks > 1 else 0):
        half = F.floor(F.size("blocks") / 2).cast("int")
        node = node.withColumn("left", F.slice("blocks", 1, half)).withColumn("right", F.slice("blocks", half + 1, F.size("blocks")))
        node = node.withColumn("draws", F.aggregate("left", F.lit(0).cast("long"), lambda a, b: a + b["n"]))
        start = F.struct(F.col("total").alias("population"), F.col("draws").alias("draws"), F.array().cast("array<bigint>").alias("out"))

        def draw(s: Column, good: Column) -> Column:
            first = F.element_at("blocks", 1)["block"]
            taken = hypergeometric(s["population"], good, s["draws"], _uniform(F.lit(seed), F.lit(level), first, F.size(s["out"])))
            return _let(taken, lambda x: F.struct((s["population"] - good).alias("population"), (s["draws"] - x).alias("draws"), F.concat(s["out"], F.array(x)).alias("out")))

        node = node.withColumn("taken", F.aggregate("rows", start, draw, lambda s: s["out"]))
        first = F.struct(F.col("left").alias("blocks"), F.col("draws").alias("total"), F.col("taken").alias("rows"))
        rest = F.zip_with("rows", "taken", lambda a, b: a - b)
        second = F.struct(F.col("right").alias("blocks"), (F.col("total") - F.col("draws")).alias("total"), rest.alias("rows"))
        whole = F.struct("blocks", "total", "rows")
        node = node.select(F.explode(F.when(F.size("blocks") > 1, F.array(first, second)).otherwise(F.array(whole))).alias("node")).select("node.*")
        if level == SPREAD_LEVEL:
            node = node.repartition(1 << SPREAD_LEVEL)
    ends = F.transform(F.sequence(F.lit(1), F.lit(shards)), lambda s: F.aggregate(F.slice("rows", 1, s), F.lit(0).cast("long"), lambda a, b: a + b))
    return node.select(F.element_at("blocks", 1)["block"].alias("block"), ends.alias("ends"))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table only if it is known to be small."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def shuffle_rows(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, part_rows: int = PART_ROWS) -> DataFrame:
    """`docs` with law, shard, slot and grown_shard (null under this law)."""
    base, names_back = shielded(docs.drop(*_ADDED), _HELPERS)
    key = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in base.columns if c in ("doc_id", "text")])
    local = base.withColumn("_key", key).sortWithinPartitions("_key").drop("_key").withColumn("_at", F.monotonically_increasing_id())
    rows = stored(local.withColumn("_block", F.shiftright("_at", 33)).withColumn("_place", F.col("_at").bitwiseAND(_LOCAL)).drop("_at"), "permuted")
    sizes = stored(rows.groupBy(F.col("_block").alias("block")).agg(F.count(F.lit(1)).alias("n")), "blocks")
    blocks, total = sizes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    matrix = stored(communication_matrix(sizes, shards, seed), "matrix").withColumnRenamed("block", "_block")
    parts = total // shards // part_rows + 1
    sent = rows.join(_bounded(matrix, blocks), "_block")
    sent = sent.withColumn("shard", F.size(F.filter("ends", lambda e: e <= F.col("_place"))).cast("int")).drop("ends")
    sent = sent.withColumn("_key", F.xxhash64(F.lit(seed + 1), "_block", "_place")).withColumn("_part", F.pmod(F.shiftright("_key", 16), F.lit(parts)))
    counts = sent.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "_part").orderBy("_key", "_block", "_place"))
    out = sent.withColumn("_rank", inside).join(_bounded(offsets, parts * shards), ["shard", "_part"])
    return names_back(out.select(
        *[F.col(f"`{c}`") for c in base.columns], F.lit("rows").alias("law"), "shard", (F.col("_offset") + F.col("_rank") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    ))
