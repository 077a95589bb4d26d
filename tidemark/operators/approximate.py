"""Approximate set-similarity join: MinHash tables, candidates confirmed on the sets.

Every pair it returns is a pair of the exact join (`similarity.similar_sets`); some may be missing. Two sets of similarity s
agree in one hash with chance s and meet if they do in any of the tables: 1 - (1 - s)^tables, which is 0.9992 for 14 tables
at the headline threshold 0.4, and more above it. It pays when most tokens are frequent, where prefixes of rare tokens say
little.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF, MinHashLSH
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .similarity import _EPS, SIGNATURE, candidates, signature

TABLES = 14
#: Size of the space that tokens are hashed into; below the prime of the library's hash functions.
SPACE = 1 << 30


def similar_sets_by_minhash(sets: DataFrame, threshold: float, tables: int = TABLES, seed: int = 7) -> DataFrame:
    """Pairs (set_a < set_b, shared, jaccard) with Jaccard >= threshold among those that share one of `tables` MinHashes.

    sets: set_id, tokens (distinct), n. Empty sets match nothing."""
    some = sets.filter(F.size("tokens") > 0).select("set_id", "tokens", "n")
    hashed = HashingTF(inputCol="tokens", outputCol="features", numFeatures=SPACE, binary=True).transform(some)
    model = MinHashLSH(inputCol="features", outputCol="hashes", numHashTables=tables, seed=seed).fit(hashed)
    signs = some.select("set_id", F.explode("tokens").alias("token")).groupBy("set_id").agg(*signature(F.col("token")))
    values = model.transform(hashed).select("set_id", "n", F.posexplode("hashes").alias("table", "hash"))
    # Tables hold ids and signatures, never the sets: these are looked up for the pairs that are left.
    postings = stored(values.select("set_id", "n", "table", vector_to_array("hash")[0].alias("value"), F.lit(0).alias("pos")).join(signs.hint("merge"), "set_id"), "minhash")
    met = candidates(postings.select("set_id", "n", "pos", "table", "value", *SIGNATURE), ["table", "value"], threshold).distinct()
    side = lambda x: some.select(F.col("set_id").alias(f"set_{x}"), F.col("tokens").alias(f"tokens_{x}"), F.col("n").alias(f"n_{x}")).hint("merge")
    shared = F.size(F.array_intersect("tokens_a", "tokens_b"))
    both = met.join(side("a"), "set_a").join(side("b"), "set_b")
    pairs = both.select("set_a", "set_b", shared.alias("shared"), (F.col("n_a") + F.col("n_b")).alias("total"))
    return pairs.withColumn("jaccard", F.col("shared") / (F.col("total") - F.col("shared"))).filter(F.col("jaccard") >= threshold - _EPS).drop("total")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: pairs of the exact join, pairs that are not of it, and the share of its pairs that were found."""
    both = exact.select("set_a", "set_b", F.lit(1).alias("e")).join(found.select("set_a", "set_b", F.lit(1).alias("f")), ["set_a", "set_b"], "full")
    counts = both.agg(F.count("e").alias("pairs"), F.count_if(F.col("e").isNull()).alias("wrong"), F.count_if(F.col("e").isNotNull() & F.col("f").isNotNull()).alias("hit"))
    return counts.select("pairs", "wrong", F.coalesce(F.try_divide("hit", "pairs"), F.lit(1.0)).alias("recall"))
