"""Keywords at word starts against a pattern per keyword."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import learn

KEYWORDS = ["eval", "e", "on the", "(c)", "a/b", "pass@", "ière", "sch", "gpu-2", "Über", "x.y", ".", "no such", "evaluation", "the end"]


def starts(keyword, body):
    return re.search(r"(?<![a-z0-9])" + re.escape(keyword.lower()), (body or "").lower()) is not None


def bodies(seed):
    rng = random.Random(seed)
    parts = ["eval", "uation", " ", " ", "on", "the", "(c)", "a/b", "pass@1", "ière", "x.y", ".", "sch", "-", "gpu-2", "1", "über", "\n", "end", "é"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(200)] + [None, "", "EVAL", "reeval", "on the", "non the", "a on the end"]


@pytest.mark.parametrize("seed", range(3))
def test_keyword_table_equals_a_pattern_each(spark, seed):
    rows = [(i, t) for i, t in enumerate(bodies(seed))]
    items = spark.createDataFrame(rows, "id long, t string")
    table = spark.createDataFrame([("ab"[k % 2], k, w) for k, w in enumerate(KEYWORDS)], "gap string, pos int, keyword string")
    got = {(r.id, r.gap): r.keywords for r in learn.keyword_matches(items, "id", F.col("t"), table).collect()}
    want = {}
    for i, t in rows:
        for k, w in enumerate(KEYWORDS):
            if starts(w, t):
                want.setdefault((i, "ab"[k % 2]), []).append(w)
    assert got == want


def test_hits_of_a_few_keywords(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(bodies(9))], "id long, t string")
    for r in rows.select("t", text.keyword_hits(F.col("t"), KEYWORDS).alias("k")).collect():
        assert r.k == [w for w in KEYWORDS if starts(w, r.t)]


def test_many_keywords_on_one_text(spark):
    table = spark.range(20_000).select(F.lit("g").alias("gap"), F.col("id").alias("pos"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("keyword"))
    items = spark.createDataFrame([(1, "w19999 and w7x, xw8")], "id long, t string")
    row = learn.keyword_matches(items, "id", F.col("t"), table).first()
    assert row.keywords == ["w1", "w7", "w19", "w199", "w1999", "w19999"]


def test_keywords_are_not_shuffled_row_by_row(spark):
    table = spark.range(100).select(F.lit("g").alias("gap"), F.col("id").alias("pos"), F.concat(F.lit("w"), F.col("id").cast("string")).alias("keyword"))
    items = spark.createDataFrame([(1, "w99 w9x"), (2, "w5 (w5)")], "id long, t string")
    found = learn.keyword_matches(items, "id", F.col("t"), table)
    dealt = [x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(" in x]
    assert dealt and not any("keyword#" in x.split("hashpartitioning(")[1] for x in dealt)
    assert sorted((r.id, r.keywords) for r in found.collect()) == [(1, ["w9", "w99"]), (2, ["w5"])]
