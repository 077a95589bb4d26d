"""URL rules by lookup of host-suffix and path-prefix expressions (operator 10).

Every address is expanded into (host suffix, path prefix) expressions, one for each suffix of its host at a dot and each
length of path that some rule has. Expressions meet the rules on a short prefix of their SHA-256; the full digest and the
text decide whether a meeting is a match. The longest matching rule wins, ties go to the smaller rule text.

Expressions are made per distinct (host, first part of the path as long as the longest rule path), so a hot host or a
repeated address costs one expansion. A list of rules whose size has been checked is broadcast, a longer one is joined
by a shuffle of the distinct expressions.

Defined cases: null address, or one without "://": host and path are empty, no rule, `default`. A host of many labels has
all its suffixes tried. Repeated rows each get their row. An empty rule list gives `default` everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
BROADCAST_RULES = 100_000
PREFIX_BITS = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    """Of host and path; the path starts with its slash or is empty, so the two can't run together."""
    return F.sha2(F.concat_ws("\n", host, path), 256)


def _short(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, PREFIX_BITS // 4), 16, 10).cast("long")


def rule_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) of the rules with their digest and its short prefix."""
    out = spark.createDataFrame(list(rules), "rule_host string, rule_path string, rule_verdict string")
    return out.withColumn("rule_digest", _digest(F.col("rule_host"), F.col("rule_path"))).withColumn("short", _short(F.col("rule_digest")))


def judge(addresses: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow", url: str = "url") -> DataFrame:
    """`addresses` with host, path, rule and verdict. Columns of these names in the input are replaced."""
    spark = addresses.sparkSession
    lengths = sorted({len(p) for _, p, _ in rules})
    base = addresses.drop("host", "path", "rule", "verdict", "head")
    parts = base.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    cut = max(lengths, default=0)
    keys = parts.select("host", F.substring("path", 1, cut).alias("head")).distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    heads = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.char_length("head"))
    expressions = (
        keys.withColumn("suffix", F.explode(suffixes))
        .withColumn("n", F.explode(heads))
        .select("host", "head", "suffix", F.substring("head", F.lit(1), F.col("n")).alias("prefix"))
        .withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
        .withColumn("short", _short(F.col("digest")))
    )
    listed = rule_table(spark, rules)
    if len(rules) <= BROADCAST_RULES:
        met = expressions.join(F.broadcast(listed), "short")
    else:
        unique = expressions.select("short", "digest", "suffix", "prefix").distinct().join(listed, "short")
        unique = unique.filter(F.col("digest") == F.col("rule_digest")).drop("rule_digest", "short")
        met = expressions.join(unique, ["digest", "suffix", "prefix"]).withColumn("rule_digest", F.col("digest"))
    exact = met.filter((F.col("digest") == F.col("rule_digest")) & (F.col("suffix") == F.col("rule_host")) & (F.col("prefix") == F.col("rule_path")))
    name = F.concat("rule_host", "rule_path")
    best = exact.groupBy("host", "head").agg(F.min(F.struct((-F.char_length(name)).alias("size"), name.alias("rule"), F.col("rule_verdict").alias("verdict"))).alias("won"))
    best = best.select("host", "head", "won.rule", "won.verdict")
    judged = base.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    return (
        judged.withColumn("head", F.substring("path", 1, cut))
        .join(best, ["host", "head"], "left")
        .drop("head")
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
    )
