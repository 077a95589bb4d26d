import datetime as dt
import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.operators import placement, scoring
from tidemark.operators.ranking import rank_in_group, running_min

DAY = dt.date(2024, 1, 8)


def sources(spark, rows):
    return spark.createDataFrame(rows, "item_id long, domain string, tier string")


@pytest.mark.parametrize("rows, credibility, verified", [
    ([("a", "primary"), ("b", "press")], 1 - 0.4 * 0.55, True),
    ([("a", "press")] * 3, 0.45, False),
    ([(f"d{i}", "press") for i in range(8)], 1 - 0.55**3, True),
    ([("a", "press"), ("b", "social")], 1 - 0.55 * 0.9, False),
    ([("a", "press"), ("b", "trade")], 1 - 0.55 * 0.75, True),
    ([("a", "social"), ("a", "primary")], 0.6, True),
])
def test_source_profile(spark, rows, credibility, verified):
    got = scoring.source_profile(sources(spark, [(1, d, t) for d, t in rows])).first()
    assert got["credibility"] == pytest.approx(credibility)
    assert got["verified"] is verified


def test_baseline_skips_missing_days(spark):
    day = lambda n: DAY - dt.timedelta(days=n)
    rows = [(1, day(1), "X", 0), (2, day(1), "x", 1), (3, day(3), "Y", 0), (4, DAY, "X", 0), (5, day(8), "X", 0)]
    e = spark.createDataFrame(rows, "id long, issue_date date, entity string, pos int")
    got = {(r["issue_date"], r["entity_key"]): r for r in scoring.mentions_with_baseline(e).collect()}
    assert got[(DAY, "x")]["mentions"] == 1
    assert got[(DAY, "x")]["baseline"] == pytest.approx(2 / 2)  # two archived days, the eighth is too old
    assert got[(day(8), "x")]["baseline"] == 0.0


def test_total_is_the_weighted_sum(spark):
    items = spark.createDataFrame([(1, DAY, "X", 0.6, 0.5, 3)], "id long, issue_date date, entity string, impact double, novelty double, coverage int")
    e = spark.createDataFrame([(1, DAY, "X", 0)], "id long, issue_date date, entity string, pos int")
    row = scoring.score(items, sources(spark, [(1, "a", "primary"), (1, "b", "press")]), e).first()
    want = 100 * (0.35 * 0.6 + 0.2 * 0.5 + 0.2 * (1 - 0.4 * 0.55) + 0.15 * (1 - math.exp(-0.5)) + 0.1 * (1 - math.exp(-1)))
    assert row["total"] == pytest.approx(want, abs=0.05)
    assert (row["coverage"], row["mentions"], row["baseline"], row["verified"]) == (3, 1, 0.0, True)


def test_canonical_entities_keep_order(spark):
    names = F.array(F.lit(" DeepMind "), F.lit("OpenAI"), F.lit("Google"))
    got = spark.range(1).select(scoring.canonical_entities(names, Settings().aliases).alias("x")).first()["x"]
    assert got == ["Google", "OpenAI"]


def placed_by_loop(rows, s):
    """Placement of one issue, item by item."""
    ranked = sorted(rows, key=lambda r: (-r["total"], -r["credibility"], r["id"]))
    used, kind = {}, {}
    for r in ranked:
        if r["verified"] and sum(used.values()) < s.leads and used.get(r["entity"], 0) < s.max_leads_per_entity:
            used[r["entity"]] = used.get(r["entity"], 0) + 1
            kind[r["id"]] = "lead"
    left = [r["id"] for r in ranked if r["id"] not in kind]
    kind.update({i: "brief" if n < s.briefs else "noted" for n, i in enumerate(left)})
    home = [r for r in ranked if r["region"] == s.quota_region]
    need = s.region_quota - sum(kind[r["id"]] != "noted" for r in home)
    waiting = sorted((r for r in home if kind[r["id"]] == "noted"), key=lambda r: not r["verified"])
    weakest = [r for r in ranked[::-1] if r["region"] != s.quota_region and kind[r["id"]] == "brief"]
    for good, bad in list(zip(waiting, weakest))[: max(need, 0)]:
        kind[good["id"]], kind[bad["id"]] = "brief", "noted"
    order = sorted(ranked, key=lambda r: ("lead", "brief", "noted").index(kind[r["id"]]))
    return {r["id"]: (kind[r["id"]], n) for n, r in enumerate(order, 1)}


def test_placement_equals_the_greedy_loop(spark):
    rng = random.Random(7)
    rows = []
    for issue in range(40):
        for i in range(rng.randint(1, 45)):
            rows.append({
                "issue_date": DAY + dt.timedelta(days=issue), "id": issue * 100 + i, "entity": rng.choice("abc"),
                "region": rng.choice(["cn", "us", "us", "us", "eu", "us", "us"]), "total": round(float(rng.choice([40, 50, 60, rng.uniform(0, 100)])), 1),
                "credibility": rng.choice([0.45, 0.6, 0.88]), "verified": rng.random() < 0.7,
            })
    df = spark.createDataFrame(rows, "issue_date date, id long, entity string, region string, total double, credibility double, verified boolean")
    s = Settings()
    got = {r["id"]: (r["placement"], r["rank"]) for r in placement.place(df, s, parts=7).collect()}
    want = {}
    for issue in {r["issue_date"] for r in rows}:
        want.update(placed_by_loop([r for r in rows if r["issue_date"] == issue], s))
    assert got == want


def test_quota_only_when_needed(spark):
    rows = [(DAY, i, f"e{i}", "us", 90.0 - i, 0.6, True) for i in range(16)] + [(DAY, 100 + i, f"c{i}", "cn", 10.0 - i, 0.6, True) for i in range(3)]
    df = spark.createDataFrame(rows, "issue_date date, id long, entity string, region string, total double, credibility double, verified boolean")
    shown = {r["id"]: r for r in placement.place_shown(df).collect()}
    assert {i for i, r in shown.items() if r["quota"] == "cn"} == {100, 101}
    assert 13 not in shown and 14 not in shown and 12 in shown
    none = placement.place_shown(df, replace(Settings(), region_quota=0)).filter("quota is not null").count()
    assert none == 0


def test_rank_in_group_with_many_ranges(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.choice([1.0, 2.0, 2.5]), rng.choice([0.1, 0.2]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, x double, y double, id long")
    got = {r["id"]: r["rank"] for r in rank_in_group(df, ["g"], [("x", False), ("y", True)], "id", parts=5).collect()}
    for g in "ab":
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2], r[3]))
        assert [got[r[3]] for r in ordered] == list(range(1, len(ordered) + 1))


def test_running_min_with_small_blocks(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), i, rng.randint(0, 50)) for i in range(200)]
    df = spark.createDataFrame(rows, "g string, pos long, v int")
    got = {r["pos"]: r["low"] for r in running_min(df, ["g"], "pos", "v", "low", block=7).collect()}
    for g in "ab":
        low = None
        for _, pos, v in [r for r in rows if r[0] == g]:
            assert got[pos] == low
            low = v if low is None else min(low, v)
