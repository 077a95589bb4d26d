"""Mixing sources to target weights by Poisson replication (operator 1, SQL functions only).

Every source has a target share of the mixed bytes; its repetition rate is share * target bytes / its own bytes. A document
is drawn a Poisson(rate) number of times: a uniform number from a hash of (seed, doc_id, part) is looked up in the cumulative
distribution of its source. A rate over `PART_RATE` is the sum of equal parts, each with its own hash, so that no
distribution is long and nothing underflows. The copies are then dealt over all partitions by a hash of (seed, doc_id, copy)
and ordered by it, which no source can skew.

Shares: `weights` for the sources it names; the rest of the weight goes to the others in proportion to bytes^alpha. With no
weights, all follow bytes^alpha. Size of a document: UTF-8 bytes of its text plus 1 (null text: 1).

Defined cases: a null source is a source of its own; a null doc_id is hashed as such; repeated rows draw the same number
each; an empty table gives none; a weight for a source without rows is ignored (its weight is not used); names that clash
with the added columns (copy, copies, rate, shuffle_key) are replaced, all other columns are kept. A weight of 0 leaves the source out.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import shielded, stored

ALPHA = 0.5
SEED = 20240611
PART_RATE = 16.0
BROADCAST_SOURCES = 10_000
_ADDED = ("copy", "copies", "rate", "shuffle_key")
_HELPERS = ("_parts", "_cum", "_source", "size", "given")


def _hash60(*parts: Column) -> Column:
    """60 bits of a digest of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])), 1, 15), 16, 10).cast("long")


def _uniform(*parts: Column) -> Column:
    return (_hash60(*parts) + F.lit(0.5)) / F.lit(float(1 << 60))


def _cumulative(rate: Column) -> Column:
    """P(X <= k) of Poisson(rate), k from 0 to where the rest is below double precision."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("cum"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["cum"], F.array(F.element_at(state["cum"], -1) + p)).alias("cum"))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda s: s["cum"])


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None = None, alpha: float = ALPHA, epochs: float = 1.0) -> DataFrame:
    """(source, size, rate) of every source; the target is `epochs` times all bytes."""
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    sizes = stored(docs.groupBy("source").agg(F.sum(size.cast("long")).alias("size")), "sources")
    named = F.lit(None).cast("double")
    if weights:
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "source string, given double")
        sizes = sizes.join(given, "source", "left")
        named = F.col("given")
    pull = F.round(F.pow(F.col("size").cast("double"), F.lit(alpha)), 6)
    total = sizes.agg(
        F.sum("size").alias("bytes"),
        F.coalesce(F.sum(named), F.lit(0.0)).alias("named"),
        F.sum(F.when(named.isNull(), pull.cast("decimal(38,6)"))).cast("double").alias("others"),
    ).first()
    left = 1.0 if not weights else max(0.0, 1.0 - total["named"])
    share = F.coalesce(named, F.lit(left) * pull / F.lit(total["others"] or 1.0))
    return sizes.select("source", "size", (share * F.lit(epochs * float(total["bytes"] or 0)) / F.col("size")).alias("rate"))


def mix_sources(docs: DataFrame, weights: Mapping[str, float] | None = None, alpha: float = ALPHA, epochs: float = 1.0, seed: int = SEED) -> DataFrame:
    """All copies of `docs` in a global random order, with copy (from 1), copies, rate and shuffle_key."""
    base, names_back = shielded(docs.drop(*_ADDED), _HELPERS)
    rates = source_rates(base, weights, alpha, epochs)
    rates = rates.withColumn("_parts", F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).cast("int"))
    rates = rates.withColumn("_cum", _cumulative(F.col("rate") / F.col("_parts"))).select(F.col("source").alias("_source"), "rate", "_parts", "_cum")
    if rates.count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    drawn = base.join(rates, base["source"].eqNullSafe(rates["_source"])).drop("_source")

    def add(n: Column, part: Column) -> Column:
        u = _uniform(F.lit(seed), F.col("doc_id"), part)
        return n + F.size(F.filter("_cum", lambda c: c <= u))

    copies = F.aggregate(F.sequence(F.lit(1), F.col("_parts")), F.lit(0), add)
    rows = drawn.withColumn("copies", copies).filter("copies > 0").drop("_parts", "_cum")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    rows = rows.withColumn("shuffle_key", _hash60(F.lit(seed), F.col("doc_id"), F.col("copy"), F.lit("order")))
    return names_back(rows.repartition("shuffle_key").sortWithinPartitions("shuffle_key"))
