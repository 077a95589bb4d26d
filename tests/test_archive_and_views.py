import datetime as dt
import json
import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.config import Gap, Settings, gap_dimension
from tidemark.functions.text import TITLE_STOP
from tidemark.operators import calendar, calibration, learn, marts, quality, views
from tidemark.sources import archive, snapshots

DAY = dt.date(2026, 10, 4)


def ts(text):
    return F.lit(text).cast("timestamp")


def test_daily_documents_by_file_name(spark, tmp_path):
    item = {"id": "a-b", "entities": ["X"], "sources": [{"url": "https://x.org", "tier": "press", "lang": "en"}], "tickers": []}
    for name in ("2024-01-01.json", "2024-01-02.json", "notes.json", "2024-01-03-draft.json"):
        (tmp_path / name).write_text(json.dumps({"date": name[:10], "items": [item], "learn": [{"id": "l", "gap": "g", "minutes": 5}]}, indent=1))
    daily = archive.read_daily(spark, str(tmp_path))
    assert sorted(str(r["issue_date"]) for r in daily.collect()) == ["2024-01-01", "2024-01-02"]
    assert archive.read_daily(spark, str(tmp_path), "2024-01-02").count() == 1
    items = archive.issue_items(daily)
    assert items.count() == 2 and archive.item_sources(items, "issue_date", "id").first()["tier"] == "press"
    assert archive.learn_of(daily).first()["minutes"] == 5


def test_weekly_documents(spark, tmp_path):
    doc = {"week": "2026-W40", "themes": [{"title": "T", "item_ids": ["b", "a", "zz"]}], "items": [{"id": "w"}], "upcoming": [{"date": "2026-11", "title": "E"}]}
    (tmp_path / "2026-W40.json").write_text(json.dumps(doc))
    (tmp_path / "index.json").write_text("{}")
    weekly = archive.read_weekly(spark, str(tmp_path))
    refs = spark.createDataFrame([("2026-W40", "a", 1.0), ("2026-W40", "b", 2.0)], "week string, id string, score double")
    listed = views.theme_items(weekly.drop("week").withColumnRenamed("file_week", "week"))
    assert [r["id"] for r in views.theme_refs(listed, refs).orderBy("pos").collect()] == ["b", "a"]
    assert [r["id"] for r in views.unresolved_refs(listed, refs).collect()] == ["zz"]
    assert archive.weekly_items(weekly).first()["id"] == "w"
    assert archive.upcoming_of(weekly, F.lit(DAY)).first()["date"] == "2026-11"


def test_items_between_keeps_duplicates_of_two_weeklies(spark):
    daily = spark.createDataFrame([(DAY, "a"), (DAY - dt.timedelta(days=9), "b")], "issue_date date, id string")
    stamp = dt.datetime(2026, 10, 3, 20)  # the fourth on the reader's clock
    weekly = spark.createDataFrame(
        [("2026-W40", "a", stamp), ("2026-W40", "b", stamp), ("2026-W40", "c", stamp), ("2026-W41", "c", stamp), ("2026-W30", "d", stamp)],
        "week string, id string, published_at timestamp")
    rows = archive.items_between(daily, weekly, F.lit(DAY - dt.timedelta(days=1)), F.lit(DAY + dt.timedelta(days=1)))
    assert sorted((r["id"], r["issue_date"]) for r in rows.collect()) == [("a", DAY), ("b", DAY), ("c", DAY), ("c", DAY)]


def test_archive_replaces_only_written_dates(spark, tmp_path):
    write = lambda rows: archive.write_archive(spark.createDataFrame(rows, "d date, id long"), str(tmp_path / "a"), "d", spread="id")
    write([(DAY, 1), (DAY, 2), (DAY - dt.timedelta(days=1), 3)])
    write([(DAY, 9)])
    assert sorted(r["id"] for r in archive.read_archive(spark, str(tmp_path / "a")).collect()) == [3, 9]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "raw")
    for i, day in enumerate(("2024-01-01 17:00:00", "2024-01-01 15:00:00", "2024-03-01 00:00:00")):
        snapshots.write_snapshot(spark.createDataFrame([(i,)], "id long"), path, ts(day))
    assert snapshots.latest_snapshot(spark, path).first()["id"] == 2
    kept = snapshots.retained(snapshots.read_snapshots(spark, path), F.lit("2024-02-01").cast("date"), 30)
    assert sorted(r["id"] for r in kept.collect()) == [0, 2]  # 2 January local is 30 days old, 1 January is not kept


def window(spark, ends, now):
    rows = spark.createDataFrame([(dt.date(2026, 9, 1) + dt.timedelta(days=i), dt.datetime.fromisoformat(e)) for i, e in enumerate(ends)], "issue_date date, window_end timestamp")
    return views.next_window(rows, ts(now)).first()


def test_next_window(spark):
    first = window(spark, [], "2026-10-04 22:00:30")
    assert first["hours"] == 24 and first["window_end"] == dt.datetime(2026, 10, 4, 22) and first["gap"] is False
    chained = window(spark, ["2026-10-02 22:00:00", "2026-10-03 22:00:00"], "2026-10-04 22:00:00")
    assert chained["window_start"] == dt.datetime(2026, 10, 3, 22)
    assert (chained["local_day"], chained["week"], chained["closes_week"]) == (DAY, "2026-W40", True)
    capped = window(spark, ["2026-09-20 22:00:00"], "2026-10-04 22:00:00")
    assert (capped["hours"], capped["gap"]) == (72, True)
    later_date_wins = window(spark, ["2026-10-03 22:00:00", "2026-10-02 22:00:00"], "2026-10-04 22:00:00")
    assert later_date_wins["window_start"] == dt.datetime(2026, 10, 2, 22)


def test_trend_keeps_gaps(spark):
    items = spark.createDataFrame([(DAY, "x"), (DAY, "y"), (DAY - dt.timedelta(days=2), "x")], "issue_date date, topic string")
    rows = views.trend(items, items.select("issue_date").distinct(), F.lit(DAY), 30, ("x", "y", "z")).orderBy("issue_date").collect()
    assert [(r["x"], r["y"], r["z"], r["missing"]) for r in rows] == [(1, 0, 0, False), (0, 0, 0, True), (1, 1, 0, False)]


def test_entity_board(spark):
    scored = spark.createDataFrame([(1, "w", 50.0), (2, "w", 40.0)], "id long, week string, total double")
    e = spark.createDataFrame([(1, "A", 0), (1, "B", 1), (2, "B", 0), (2, "A", 1)], "id long, entity string, pos int")
    rows = views.entity_board(views.entity_weights(scored, e, ["week"]), ["week"]).orderBy("rn").collect()
    assert [(r["entity"], r["weight"], r["mentions"]) for r in rows] == [("A", 60.0, 2), ("B", 52.5, 2)]


def folded(events, threshold=0.6):
    """Announcements in order, each against the merged list of its date."""
    words = lambda t: set(re.findall(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*", t.lower())) - set(TITLE_STOP)
    out = []
    for seen, pos, date, title in sorted(events, key=lambda e: (e[0], e[1])):
        for slot in out:
            a, b = words(slot[1]), words(title)
            if slot[0] == date and a | b and len(a & b) / len(a | b) >= threshold:
                slot[1] = title
                break
        else:
            out.append([date, title, seen])
    return sorted(map(tuple, out))


@pytest.mark.parametrize("seed", range(3))
def test_calendar_equals_the_fold(spark, seed):
    rng = random.Random(seed)
    events = []
    for pos in range(250):
        title = " ".join(rng.sample(["launch", "acme", "model", "beta", "summit", "paris", "the"], rng.randint(1, 4)))
        events.append((DAY - dt.timedelta(days=rng.randint(0, 40)), pos, rng.choice(["2026-10-10", "2026-11", "2026-12-01"]), title))
    df = spark.createDataFrame([(*e, "launch", "expected", None) for e in events], "seen_on date, pos long, date string, title string, kind string, confidence string, url string")
    s = replace(Settings(), calendar_horizon_days=100)
    got = sorted((r["date"], r["title"], r["first_seen"]) for r in calendar.calendar(df, F.lit(DAY), s).collect())
    assert got == folded([e for e in events if e[0] >= DAY - dt.timedelta(days=30)])


@pytest.mark.parametrize("seed", range(3))
def test_calendar_with_many_announcements_a_day(spark, seed):
    """Also the case in which a set comes back on the same day after another one has changed the slots."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(1, 7)]
    titles = ["w1 w2 w3 w4", "w2 w3 w4 w5 w6", "w1 w2 w3 w4 w5", "w1 w2 w3 w4"] + [" ".join(rng.sample(words, rng.randint(3, 5))) for _ in range(60 * seed)]
    events = [(DAY - dt.timedelta(days=i // 20), i, "2026-10-10", t) for i, t in enumerate(titles)]
    df = spark.createDataFrame([(*e, "launch", "expected", None) for e in events], "seen_on date, pos long, date string, title string, kind string, confidence string, url string")
    df = df.withColumn("pos", F.struct("pos", "title"))
    got = sorted((r["date"], r["title"], r["first_seen"]) for r in calendar.calendar(df, F.lit(DAY), replace(Settings(), calendar_horizon_days=100)).collect())
    assert got == folded(events)


def test_calendar_horizon(spark):
    ahead = lambda d: spark.range(1).select(calendar.in_horizon(F.lit(d), F.lit(DAY), 60)).first()[0]
    assert [ahead(d) for d in ("2026-10-03", "2026-10-04", "2026-10", "2026-09", "2026-12-03", "2026-12-04", "2026-12")] == [False, True, True, False, True, False, True]


GAPS = [Gap("a", "A", 2.0, 4.0, 1.0, ("eval",)), Gap("b", "B", 3.0, 4.0, 1.0, ("gpu",)), Gap("c", "C", 5.0, 4.0, 1.0, ())]


def test_gap_ranking_and_damping(spark):
    items = spark.createDataFrame([(1, DAY, "New evaluation", 0.5), (2, DAY, "gpu and eval", 0.4)], "id long, issue_date date, text string, weight double")
    matches = learn.gap_matches(items, F.col("text"), GAPS)
    taught = spark.createDataFrame([(DAY, "b"), (DAY - dt.timedelta(days=4), "a")], "issue_date date, gap string")
    dates = spark.createDataFrame([(DAY,), (DAY - dt.timedelta(days=4),)], "issue_date date")
    rows = {r["gap"]: r for r in learn.rank_gaps(matches, dates, taught, GAPS).filter(F.col("issue_date") == F.lit(DAY)).collect()}
    assert rows["a"]["days_since"] == 4 and rows["a"]["damp"] == 0.632 and rows["a"]["hook"] == 0.593
    assert rows["b"]["days_since"] is None and rows["b"]["damp"] == 1.0 and rows["c"]["score"] == 0.0
    assert [r["id"] for r in learn.hook_stories(matches, 1).filter("gap = 'a'").collect()] == [1]


def test_tracker_and_streak(spark):
    taught = spark.createDataFrame([(DAY, "a", 10), (DAY - dt.timedelta(days=29), "a", 5), (DAY - dt.timedelta(days=30), "b", 7)], "issue_date date, gap string, minutes int")
    rows = [(r["gap"], r["n"], r["minutes"]) for r in learn.tracker(taught, GAPS, F.lit(DAY)).collect()]
    assert rows == [("a", 2, 15), ("b", 0, 0), ("c", 0, 0)]
    lessons = spark.createDataFrame([(DAY - dt.timedelta(days=9 - 2 * i), n) for i, n in enumerate([1, 0, 2, 1])], "issue_date date, n_lessons int")
    assert [r["streak"] for r in learn.streaks(lessons).orderBy("issue_date").collect()] == [1, 0, 1, 2]


def test_duplicate_gap_is_an_error(spark):
    with pytest.raises(ValueError):
        gap_dimension(spark, [GAPS[0], GAPS[0]])


def test_settings_are_checked():
    with pytest.raises(ValueError):
        Settings(weights={"impact": 0.5})
    with pytest.raises(ValueError):
        Settings(reliability={"primary": 1.0})


def test_item_rules_accept_a_good_item(spark):
    schema = (
        "id string, title string, summary string, why_it_matters string, original_title string, topic string, region string, entities array<string>, "
        "key_numbers array<string>, tickers array<string>, impact double, novelty double, coverage int, published_at string, window_start timestamp, window_end timestamp"
    )
    start, end = dt.datetime(2026, 10, 3, 22), dt.datetime(2026, 10, 4, 22)
    good = ("good-1", "T", "S", "W", None, "models", "us", ["X"], [], None, 0.5, 0.5, 1, "2026-10-04T00:00:00Z", start, end)
    bad = ("Bad id", "", "S", "W", None, "sports", "mars", [""], ["1"] * 7, None, 1.5, None, 0, "2026-10-04T00:00:00", start, end)
    graced = ("grace", "T", "S", "W", None, "models", "us", ["X"], [], None, 0.5, 0.5, 1, "2026-10-03T17:00:00Z", start, end)
    items = spark.createDataFrame([good, bad, graced], schema)
    sources = spark.createDataFrame(
        [("good-1", 0, "https://x.org/a", "X", "en", "press"), ("grace", 0, "https://x.org/a", "X", "zh", "social"), ("Bad id", 0, "ftp://x", "X", "zh", "social")],
        "id string, pos int, url string, outlet string, lang string, tier string")
    found = {}
    for r in quality.item_violations(items, sources).collect():
        found.setdefault(r["id"], set()).add(r["rule"])
    assert "good-1" not in found
    assert found["grace"] == {"published in the grace period only", "Chinese source without original_title", "only social sources"}
    assert len(found["Bad id"]) == 11 and "only social sources" in found["Bad id"]
    report = quality.report(quality.item_violations(items, sources), "id")
    assert {r["id"]: r["ok"] for r in report.collect()} == {"grace": True, "Bad id": False}


def test_calibration_needs_three_items(spark):
    row = (60.0, 0.5, 0.5, 0.6, 0.4, 0.6)
    schema = "total double, impact double, novelty double, credibility double, breadth double, momentum double"
    assert calibration.component_spread(spark.createDataFrame([row, row], schema)).count() == 0
    rows = {r["component"]: r for r in calibration.component_spread(spark.createDataFrame([row, row, row], schema)).collect()}
    assert rows["impact"]["near_constant"] and rows["impact"]["variance_share"] is None


def test_feed_entries_and_difference(spark):
    dailies = spark.createDataFrame([(DAY, dt.datetime(2026, 10, 4, 22))], "issue_date date, window_end timestamp")
    entries = marts.feed_entries(dailies, spark.createDataFrame([("2026-W40",)], "week string")).collect()
    assert [e["id"] for e in entries] == ["weekly-2026-W40", "daily-2026-10-04"]
    a, b = spark.createDataFrame([(1, 1.0), (2, 2.0)], "id long, x double"), spark.createDataFrame([(1, 1.0), (2, 2.5)], "id long, x double")
    assert sorted((r["side"], r["x"]) for r in marts.difference(a, b).collect()) == [("fresh", 2.0), ("stored", 2.5)]
    assert marts.difference(a, a).count() == 0


def test_open_per_day_counts_ranges_without_their_days(spark):
    rows = spark.sql("SELECT * FROM VALUES (DATE'2024-01-01', DATE'2024-01-03'), (DATE'2024-01-03', DATE'2024-01-03'), (DATE'2024-01-06', DATE'2024-01-06'), (DATE'2024-01-09', DATE'2024-01-08'), (null, DATE'2024-01-08') t(a, z)")
    assert [(str(r.day), r.n) for r in views.open_per_day(rows, "a", "z").orderBy("day").collect()] == [
        ("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 2), ("2024-01-06", 1)
    ]
    long = spark.range(100_000).selectExpr("DATE'0001-01-01' AS a", "date_add(DATE'2024-01-01', CAST(id % 3 AS INT)) AS z")
    assert views.open_per_day(long, "a", "z").agg(F.sum("n"), F.max("n")).first()[1] == 100_000


def test_item_entities_are_dealt_by_the_size_of_the_table(spark, monkeypatch):
    """A task's share stays the same when the table grows; few rows are left to the session, and results do not depend on it."""
    from tidemark import session
    from tidemark.plans import bindings as b

    sf = "/root/testdata/sf0.001"
    few = b.item_entities(spark, sf, b.all_items(spark, sf))
    assert "REPARTITION_BY_NUM" not in few._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(session, "ROWS_A_PART", 300)
    many = b.item_entities(spark, sf, b.all_items(spark, sf))
    assert many._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM") >= 3
    assert session.dealt(spark.range(10), 6_000, "id").rdd.getNumPartitions() == 20
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))


def test_dashboard_works_out_a_table_once(spark, tmp_path):
    """ranging samples its rows, and tables that were only planned were worked out for the sample and for the writer."""
    seen = spark.sparkContext.accumulator(0)

    def counted(n: int) -> int:
        seen.add(1)
        return n

    days = spark.range(50).select(F.date_add(F.lit("2024-01-01").cast("date"), F.udf(counted, "int")(F.col("id").cast("int"))).alias("issue_date"))
    marts.write_dashboard({"trend": days}, str(tmp_path / "mart"))
    assert seen.value == 50 and spark.read.parquet(str(tmp_path / "mart" / "trend")).count() == 50


def test_counts_by_without_a_pivot(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (1, "c"), (2, None), (None, "b")], "k int, v string")
    out = views.counts_by(rows, ["k"], "v", ["a", "b"])
    assert {tuple(r) for r in out.collect()} == {(1, 2, 0), (2, 0, 0), (None, 0, 1)}
    assert "pivotfirst" not in out._jdf.queryExecution().optimizedPlan().toString()
