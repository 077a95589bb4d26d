import datetime as dt
import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import clusters, components, dedupe, similarity

DAY = dt.date(2024, 1, 10)
WORDS = [f"w{i}" for i in range(12)]


def random_sets(rng, n):
    return [frozenset(rng.sample(WORDS, rng.randint(1, 7))) for _ in range(n)]


def overlap(a, b):
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("threshold", [0.2, 0.4, 0.5, 0.6, 0.8])
@pytest.mark.parametrize("hot", [0, 5, 20, 10_000])
def test_similar_sets_equals_all_pairs(spark, threshold, hot):
    """Whatever counts as a hot token, the result is that of comparing all pairs."""
    rows = list(enumerate(random_sets(random.Random(11), 90)))
    df = spark.createDataFrame([(i, sorted(s)) for i, s in rows], "id long, words array<string>")
    sets = similarity.distinct_sets(df, "id", F.col("words"))
    got = {(r["set_a"], r["set_b"]): r["jaccard"] for r in similarity.similar_sets(sets, threshold, hot).collect()}
    first = {}
    for i, s in rows:
        first.setdefault(s, i)
    want = {
        (min(i, j), max(i, j)): overlap(a, b)
        for (a, i), (b, j) in combinations(first.items(), 2) if overlap(a, b) >= threshold
    }
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_pairs_far_apart_do_not_leave_the_join(spark):
    """Sets that only share a frequent token of their prefixes meet in the join, but hardly any of them is a candidate."""
    rows = [(i, ["common", *(f"w{i}-{k}" for k in range(20))], 21) for i in range(200)] + [(200, ["common", *(f"w7-{k}" for k in range(15))], 16)]
    ordered = similarity._rare_first(spark.createDataFrame(rows, "set_id long, tokens array<string>, n int"), signed=True)
    first = ordered.select("set_id", "n", *similarity.SIGNATURE, F.lit(0).alias("pos"), F.lit("common").alias("token"))
    found = {(r.set_a, r.set_b) for r in similarity.candidates(first, ["token"], 0.5).collect()}
    assert (7, 200) in found and len(found) < 20


def test_components_of_random_graph_and_long_chain(spark):
    rng = random.Random(5)
    edges = [(rng.randint(0, 150), rng.randint(0, 150)) for _ in range(90)] + [(1000 + i, 1001 + i) for i in range(70)]
    label = {n: n for e in edges for n in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["node"]: r["component"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {n: c for n, c in label.items() if any(a != b and n in (a, b) for a, b in edges)}


def test_clusters_join_copies_and_keep_empty_titles_apart(spark):
    titles = ["big chip news", "big chip news", "chip news big today", "??", "!!", "other thing entirely"]
    df = spark.createDataFrame(list(enumerate(titles)), "id long, title string")
    rows = clusters.headline_clusters(df, text.cluster_tokens(F.col("title")), 0.4).collect()
    assert {r["id"]: r["component"] for r in rows} == {0: 0, 1: 0, 2: 0, 3: 3, 4: 4, 5: 5}


def test_roll_up_prefers_tier_then_direct_then_early(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    rows = [
        (1, 10, "A", "u1", "en", "x", "press", "gnews", t(1), None, 3), (1, 11, "B", "u2", "en", "y", "press", "rss", t(2), 7, None),
        (1, 12, "C", "u3", "en", "y", "trade", "rss", t(0), None, None),
    ]
    df = spark.createDataFrame(rows, "component long, id long, title string, url string, lang string, outlet string, tier string, via string, published_at timestamp_ntz, hn_points long, hf_upvotes long")
    r = clusters.roll_up(df).first()
    assert (r["best_id"], r["n_outlets"], r["n_items"], r["first_seen"], r["hn_points"], r["hf_upvotes"]) == (11, 2, 3, t(0), 7, 3)
    assert {(r["outlet"], r["n_items"]) for r in clusters.cluster_outlets(df).collect()} == {("x", 1), ("y", 2)}
    assert {r["id"]: r["position"] for r in clusters.placed_members(df, 2).collect()} == {12: 1, 10: 2, 11: 3}


def random_links(rng):
    return {(i, DAY + dt.timedelta(days=i % 13), f"u{rng.randint(0, 6)}") for i in range(60) for _ in range(2)}


def link_pairs(links, follow):
    for i, di, u in links:
        for j, dj, v in links:
            gap = (di - dj).days
            if u == v and follow.get(i) != j and (1 <= gap <= 7 or (gap == 0 and j < i)):
                yield i, j, u, di, dj


def test_url_conflicts_equal_all_pairs(spark):
    rng = random.Random(2)
    links = random_links(rng)
    follow = {i: rng.randint(0, 59) for i in range(0, 60, 3)}
    df = spark.createDataFrame(sorted(links), "id long, issue_date date, url string")
    fdf = spark.createDataFrame(sorted(follow.items()), "id long, follow_up_of long")
    pairs = list(link_pairs(links, follow))
    got = {(r["url"], r["issue_date"], r["other_date"]): r["n_pairs"] for r in dedupe.url_conflicts(df, fdf).collect()}
    assert got == Counter((u, di, dj) for _, _, u, di, dj in pairs)
    by_item = {r["id"]: (r["n_conflicts"], r["detail"]) for r in dedupe.url_conflicts_by_item(df, fdf, parts=4).collect()}
    want = {i: (n, min(u for k, _, u, _, _ in pairs if k == i)) for i, n in Counter(p[0] for p in pairs).items()}
    assert by_item == want


def test_title_conflicts(spark):
    rows = [
        (1, DAY, "Acme ships new chip line", ["acme"]), (2, DAY, "Acme ships chip line early", ["acme", "beta"]),
        (3, DAY, "Acme ships new chip line", ["other"]), (4, DAY - dt.timedelta(days=7), "Acme ships new chip line", ["acme"]),
        (5, DAY - dt.timedelta(days=8), "Acme ships new chip line", ["acme"]), (6, DAY, "Acme ships new chip line", ["acme"]),
    ]
    df = spark.createDataFrame(rows, "id long, issue_date date, title string, entities array<string>")
    none = spark.createDataFrame([], "id long, follow_up_of long")
    tokens = text.title_tokens(F.col("title"))
    count = lambda f: dedupe.title_conflicts(df, tokens, f).agg(F.sum("n_pairs")).first()[0]
    # {1,2,6} against each other on the day, each against 4, and 4 against 5.
    assert count(none) == 3 + 3 + 1
    assert count(spark.createDataFrame([(2, 1), (6, 4)], "id long, follow_up_of long")) == 5
    assert count(spark.createDataFrame([(1, 2)], "id long, follow_up_of long")) == 7  # the older cannot follow the newer


@pytest.mark.parametrize("seed", [3, 4])
def test_title_conflicts_by_item_equal_all_pairs(spark, seed):
    """Few titles, entities and links over three weeks, so that one title and one link hold about a third of the items."""
    rng = random.Random(seed)
    sets = random_sets(rng, 8)
    items = [
        (i, DAY + dt.timedelta(days=rng.randint(0, 20)), sorted(sets[0] if rng.random() < 0.35 else rng.choice(sets)), rng.sample(["a", "b", "c"], rng.randint(1, 2)))
        for i in range(150)
    ]
    links = {(i, d, "hot" if rng.random() < 0.35 else f"u{rng.randint(0, 30)}") for i, d, _, _ in items for _ in range(rng.randint(0, 3))}
    follow = {i: rng.randint(0, 149) for i in range(0, 150, 2)}
    mine = {i: {u for k, _, u in links if k == i} for i in range(150)}
    want = Counter(
        i for i, di, ti, ei in items for j, dj, tj, ej in items
        if (1 <= (di - dj).days <= 7 or (di == dj and j < i)) and follow.get(i) != j and not mine[i] & mine[j] and set(ei) & set(ej)
        and overlap(set(ti), set(tj)) >= 0.5
    )
    df = spark.createDataFrame(items, "id long, issue_date date, words array<string>, entities array<string>")
    ldf = spark.createDataFrame(sorted(links), "id long, issue_date date, url string")
    fdf = spark.createDataFrame(sorted(follow.items()), "id long, follow_up_of long")
    got = {r["id"]: r["n_conflicts"] for r in dedupe.title_conflicts_by_item(df, F.col("words"), ldf, fdf, parts=4).collect()}
    assert got == dict(want)


def test_duplicate_ids(spark):
    df = spark.createDataFrame([(DAY, 1), (DAY, 1), (DAY, 1), (DAY, 2)], "issue_date date, id long")
    assert [(r["id"], r["n_conflicts"]) for r in dedupe.duplicate_ids(df).collect()] == [(1, 2)]


@pytest.mark.parametrize("seed", [5, 6])
def test_title_pairs_leave_out_pairs_with_a_common_link(spark, seed):
    """Cells of one title, with a hot title and a hot link, against all pairs."""
    rng = random.Random(seed)
    sets = random_sets(rng, 8)
    items = [
        (i, DAY + dt.timedelta(days=rng.randint(0, 12)), sorted(sets[0] if rng.random() < 0.35 else rng.choice(sets)), rng.sample(["a", "b", "c"], rng.randint(1, 2)))
        for i in range(140)
    ]
    links = {(i, d, "hot" if rng.random() < 0.35 else f"u{rng.randint(0, 20)}") for i, d, _, _ in items for _ in range(rng.randint(0, 3))}
    follow = {i: rng.randint(0, 139) for i in range(0, 140, 2)}
    mine = {i: {u for k, _, u in links if k == i} for i in range(140)}
    pairs = [
        (di, dj) for i, di, ti, ei in items for j, dj, tj, ej in items
        if (1 <= (di - dj).days <= 7 or (di == dj and j < i)) and follow.get(i) != j and not mine[i] & mine[j] and set(ei) & set(ej)
        and overlap(set(ti), set(tj)) >= 0.5
    ]
    df = spark.createDataFrame(items, "id long, issue_date date, words array<string>, entities array<string>")
    ldf = spark.createDataFrame(sorted(links), "id long, issue_date date, url string")
    fdf = spark.createDataFrame(sorted(follow.items()), "id long, follow_up_of long")
    found = dedupe.title_conflicts(df, F.col("words"), fdf, item_urls=ldf).groupBy("date_a", "date_b").agg(F.sum("n_pairs").alias("n")).collect()
    assert {(r.date_a, r.date_b): r.n for r in found} == Counter(pairs)


def test_url_conflicts_make_rows_only_for_cells_that_meet(spark):
    links = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-01', 'a'), (2, DATE'2024-01-01', 'a'), (3, DATE'2024-03-01', 'a'), (4, DATE'2024-03-01', null), (5, null, 'a') t(id, issue_date, url)")
    none = spark.sql("SELECT 1 AS id, 1 AS follow_up_of WHERE false")
    found = dedupe.url_conflicts(links, none, days=60)
    assert sorted((str(r.issue_date), str(r.other_date), r.n_pairs) for r in found.collect()) == [("2024-01-01", "2024-01-01", 1), ("2024-03-01", "2024-01-01", 2)]
    assert "sequence(" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_only_links_that_meet_are_numbered_and_joined(spark, monkeypatch):
    """Of 300 links five meet: two on one day, two within the days, one pair too far apart; null links meet nothing."""
    rows = [(i, DAY + dt.timedelta(i % 5), f"https://a.example/{i}") for i in range(300)]
    rows += [(400, DAY, "https://z/1"), (401, DAY, "https://z/1"), (402, DAY, "https://y"), (403, DAY + dt.timedelta(7), "https://y")]
    rows += [(404, DAY, "https://x"), (405, DAY + dt.timedelta(8), "https://x"), (401, DAY, "https://b"), (399, DAY, "https://b"), (406, DAY, None), (407, DAY, None)]
    df = spark.createDataFrame(rows, "id long, issue_date date, url string")
    follow_ups = spark.createDataFrame([(403, 402)], "id long, follow_up_of long")
    kept, stored = {}, dedupe.stored

    def keep(df, name):
        kept[name] = stored(df, name)
        return kept[name]

    monkeypatch.setattr(dedupe, "stored", keep)
    links, names = dedupe.numbered_links(df)
    named = [r.link for r in names.orderBy("url").collect()]
    assert named == sorted({u for *_, u in rows if u}) and dict(links.dtypes)["url"] == "bigint"
    for marks, want in ((follow_ups, {(401, 2, "https://b")}), (follow_ups.limit(0), {(401, 2, "https://b"), (403, 1, "https://y")})):
        found = dedupe.url_conflicts_by_item(links, marks, parts=3).join(names, F.col("detail") == F.col("url")).collect()
        assert {(r.id, r.n_conflicts, r.link) for r in found} == want
        assert {r.id for r in kept["met_links"].collect()} == {399, 400, 401, 403}
        assert {(r.id, r.n_conflicts, r.detail) for r in dedupe.url_conflicts_by_item(df, marks).collect()} == want


@pytest.mark.parametrize(("many", "pairs"), [(24, 1 << 16), (2, 50), (10_000, 50)])
def test_sets_of_a_block_meet_as_arrays(monkeypatch, many, pairs):
    """Sets of 1 to 900 tokens: all that are similar, each pair once, and hardly any others, wherever batches end."""
    monkeypatch.setattr(similarity, "MANY", many)
    monkeypatch.setattr(similarity, "PAIRS", pairs)
    rng = random.Random(many)
    sets = []
    for _ in range(40):
        base = rng.sample(range(5000), rng.choice([1, 3, 9, 40, 300, 900]))
        sets += [{-1, *base}, {-1, *rng.sample(base, rng.randint((len(base) + 1) // 2, len(base))), rng.randrange(5000)}]
    blocks = [(i % 7, s) for i, s in enumerate(sets)]
    order = sorted(range(len(blocks)), key=lambda i: (blocks[i][0], len(blocks[i][1])))
    place = {t: rng.randrange(512) for t in range(-1, 5000)}
    signs = {i: sum(1 << p for p, k in Counter(place[t] for t in blocks[i][1]).items() if k % 2) for i in order}
    words = {f"s{k}": [(signs[i] >> 64 * k) % (1 << 64) for i in order] for k in range(8)}
    columns = {"block": [blocks[i][0] for i in order], "set_id": order, "n": [len(blocks[i][1]) for i in order], "pos": [0] * len(order),
               **{name: np.array(v, dtype=np.uint64).view(np.int64) for name, v in words.items()}, **{c: [0] * len(order) for c in ("part", "i", "j")}}
    table = pa.table(columns)
    found = [(min(p), max(p)) for b in similarity._met(0.4, None)(iter(table.to_batches(max_chunksize=9))) for p in zip(*(b.column(c).to_pylist() for c in ("x", "y")), strict=True)]
    want = {(i, j) for (i, (b, s)), (j, (c, t)) in combinations(enumerate(blocks), 2) if b == c and len(s & t) >= 0.4 * len(s | t)}
    assert len(found) == len(set(found)) and want <= set(found) and len(found) <= 2 * len(want) + 100


def test_blocks_in_parts_and_keys_of_one_set(spark, monkeypatch):
    """A block in parts gives the pairs of the whole block; nothing is joined with itself, and keys of one set are left out."""
    rows = [(i, ["common", *(f"w{i // 4}-{k}" for k in range(9)), f"own{i}"], 11) for i in range(120)]
    ordered = similarity.cut(similarity._rare_first(spark.createDataFrame(rows, "set_id long, tokens array<string>, n int"), signed=True))
    posted = ordered.select("set_id", "n", *similarity.SIGNATURE, F.lit(0).alias("pos"), F.explode(F.array(F.lit("common"), F.concat(F.lit("x"), "set_id"))).alias("token"))
    want = {(a, b) for a, b in combinations(range(120), 2) if a // 4 == b // 4}
    for block in (4096, 13):
        monkeypatch.setattr(similarity, "BLOCK", block)
        met = similarity.candidates(posted, ["token"], 0.5)
        found = [(r.set_a, r.set_b) for r in met.collect()]
        assert len(found) == len(set(found)) and want <= set(found) and len(found) <= 2 * len(want)
        sized = similarity.candidates(posted.withColumn("size", F.when(F.col("token") == "common", 120).otherwise(1)), ["token"], 0.5)
        assert "Join" not in sized._jdf.queryExecution().executedPlan().toString() and sorted(map(tuple, sized.collect())) == sorted(found)
