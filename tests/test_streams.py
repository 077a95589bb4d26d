"""Streams with state against batch loops, over several micro-batches and after a restart."""

import datetime as dt
import math
import random

import pytest

from tidemark.config import Settings
from tidemark.streaming import bursts
from tidemark.streaming import events as st

SCHEMA = "ts timestamp, user string"
START = dt.datetime(2024, 1, 1)


@pytest.fixture
def session(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", "2")
    bursts.state_store(own)
    return own


def event_rows(seed, n=400, days=20):
    rng = random.Random(seed)
    rows = sorted((START + dt.timedelta(days=rng.choice([d for d in range(days) if d % 7 != 3]), seconds=rng.randrange(86_400)), rng.choice("abbbbcde")) for _ in range(n))
    # Some come late, but within the lateness.
    for k in range(5, n, 29):
        rows[k], rows[k - 5] = rows[k - 5], rows[k]
    return rows


def write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def expected(rows, look):
    days = {}
    for ts, user in rows:
        if user:
            days.setdefault(user, {}).setdefault(ts.date(), []).append(ts)
    seen = {ts.date() for ts, user in rows if user}
    out = []
    for user, own in days.items():
        for day, hits in own.items():
            back = [day - dt.timedelta(days=k) for k in range(1, look + 1)]
            archived = sum(d in seen for d in back)
            base = sum(len(own.get(d, [])) for d in back) / archived if archived else 0.0
            out.append((day, user, len(hits), round(1 - math.exp(-len(hits) / (base + 1)), 9)))
    return sorted(out)


@pytest.mark.parametrize("restart", [False, True])
def test_bursts_with_state_per_key(spark, session, tmp_path, restart):
    rows, path = event_rows(1), str(tmp_path / "in")
    parts = [rows[k : k + 80] for k in range(0, len(rows), 80)]
    beat = [(rows[-1][0] + dt.timedelta(days=40), None)]
    where, seen_at = str(tmp_path / "bursts"), str(tmp_path / "days")

    def run():
        for stream, out in ((bursts.day_bursts, where), (st.trailing_days, seen_at)):
            args = ("ts", "user") if stream is bursts.day_bursts else ("ts",)
            st.run_append(stream(st.read_events(session, path, session.createDataFrame([], SCHEMA).schema), *args, Settings()), session, "x", out)

    for k, part in enumerate([*parts, beat]):
        write(session, path, part)
        if restart and k in (1, 3):
            run()  # the next run goes on from the checkpoint
    run()
    found = bursts.momentum_of(spark.read.parquet(f"{where}/rows"), spark.read.parquet(f"{seen_at}/rows"))
    got = sorted((r.day, r.user, r.n, round(r.momentum, 9)) for r in found.collect())
    assert got == expected(rows, Settings().baseline_days)


def test_baseline_from_the_stream_alone(spark, session, tmp_path):
    rows, path = event_rows(2), str(tmp_path / "in")
    for k in range(0, len(rows), 100):
        write(session, path, rows[k : k + 100])
    write(session, path, [(rows[-1][0] + dt.timedelta(days=40), None)])
    stream = lambda: st.read_events(session, path, session.createDataFrame([], SCHEMA).schema)
    counts = st.run_append(st.trailing_counts(stream(), "ts", "user", Settings()), session, "x", str(tmp_path / "counts"))
    days = st.run_append(st.trailing_days(stream(), "ts", Settings()), session, "x", str(tmp_path / "days"))
    found = st.baseline_from_stream(spark.read.parquet(counts).filter("user is not null"), spark.read.parquet(days))
    got = {(r.day, r.user): r.baseline for r in found.collect()}
    seen, want = {ts.date() for ts, _ in rows}, {}
    for d in range(1, 30):
        day = (START + dt.timedelta(days=d)).date()
        back = {day - dt.timedelta(days=k) for k in range(1, 8)}
        for user in "abcde":
            n = sum(ts.date() in back and u == user for ts, u in rows)
            if n:
                want[(day, user)] = n / len(seen & back)
    assert got == want


class FakeHandle:
    """A key's state and timers, as calls."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, ms):
        self.timers.append(ms)


def test_one_timer_puts_out_all_closed_days():
    """Twenty days that close together cost one timer, not twenty."""
    handle, made = FakeHandle(), bursts.DayBursts(7)
    made.init(handle)
    list(made.handleInputRows(("a",), iter([{"day": d, "n": 2} for d in range(100, 120)]), None))
    assert handle.timers == [101 * bursts.DAY_MS]
    now = type("Now", (), {"getCurrentWatermarkInMs": lambda self: 118 * bursts.DAY_MS + 5})()
    out = list(made.handleExpiredTimer(("a",), now, None))
    assert [(r.day, r.n, r.before) for r in out] == [(d, 2, 2 * min(7, d - 100)) for d in range(100, 118)]
    assert handle.timers[1:] == [119 * bursts.DAY_MS]
    assert sorted(handle.value[0]) == list(range(111, 120)) and list(made.handleExpiredTimer(("a",), now, None)) == []
