import datetime as dt
import math
import random
import statistics as st

import pytest

from tidemark.config import Settings
from tidemark.operators import market

START = dt.date(2024, 1, 1)
SCHEMA = "symbol string, date date, close double"


def weekdays(n, start=START):
    days = []
    while len(days) < n:
        if start.weekday() < 5:
            days.append(start)
        start += dt.timedelta(days=1)
    return days


def world(n=120, shock_at=None, shock=0.0, seed=1):
    rng = random.Random(seed)
    stock, index, out = 100.0, 5000.0, []
    for i, d in enumerate(weekdays(n)):
        m = rng.gauss(0, 0.01)
        index *= 1 + m
        stock *= 1 + 0.0005 + 1.2 * m + rng.gauss(0, 0.004) + (shock if i == shock_at else 0.0)
        out += [("ACME", d, stock), ("^GSPC", d, index)]
    return out


def study(spark, prices, published, symbol="ACME"):
    events = spark.createDataFrame([(1, symbol, published)], "id long, symbol string, published_at timestamp")
    return market.event_study(events, spark.createDataFrame(prices, SCHEMA)).first()


def noon(day):
    return dt.datetime.combine(day, dt.time(12))


def by_hand(prices, day0):
    """The study written out for one event."""
    series = {s: sorted((d, c) for t, d, c in prices if t == s) for s in ("ACME", "^GSPC")}
    ret = {s: {b[0]: b[1] / a[1] - 1 for a, b in zip(v, v[1:])} for s, v in series.items()}
    days = sorted(set(ret["ACME"]) & set(ret["^GSPC"]))
    k = next(i for i, d in enumerate(days) if d >= day0)
    past = days[max(0, k - 70): k - 10]
    fit = st.linear_regression([ret["^GSPC"][d] for d in past], [ret["ACME"][d] for d in past])
    left = lambda d: ret["ACME"][d] - fit.intercept - fit.slope * ret["^GSPC"][d]
    sigma = math.sqrt(sum(left(d) ** 2 for d in past) / (len(past) - 2))
    ar = [left(d) for d in days[k:k + 3]]
    return ar, sum(ar), sum(ar) / (sigma * math.sqrt(len(ar))), fit.slope


def test_event_study_finds_the_shock(spark):
    days = weekdays(120)
    prices = world(shock_at=100, shock=0.08)
    row = study(spark, prices, noon(days[100]))
    ar, car, t, beta = by_hand(prices, days[100])
    assert row["status"] == "ok" and row["day0"] == days[100] and row["bench"] == "^GSPC"
    assert row["ar"] == pytest.approx(ar) and row["car"] == pytest.approx(car)
    assert row["t"] == pytest.approx(t) and row["beta"] == pytest.approx(beta)
    assert row["t"] > 5 and abs(row["beta"] - 1.2) < 0.25


def test_rescaled_history_changes_nothing(spark):
    prices = world()
    half = [(s, d, c / 2 if s == "ACME" else c) for s, d, c in prices]
    when = noon(weekdays(120)[100])
    assert study(spark, prices, when)["car"] == pytest.approx(study(spark, half, when)["car"])


def test_statuses(spark):
    days, prices = weekdays(120), world()
    assert study(spark, prices, noon(days[30]))["status"] == "short-history"
    assert study(spark, prices, noon(days[-2]))["status"] == "partial"
    assert study(spark, prices, noon(days[-1] + dt.timedelta(days=9)))["status"] == "pending"
    assert study(spark, prices, noon(days[50]), "NONE")["status"] == "no-data"
    assert study(spark, [p for p in prices if p[0] == "ACME"], noon(days[50]))["status"] == "no-data"
    late = [p for p in prices if p[0] == "ACME" or p[1] < days[100]]
    row = study(spark, late, noon(days[110]))
    assert (row["status"], row["day0"]) == ("pending", days[110])


def test_day_zero_is_strictly_after_publication(spark):
    prices = spark.createDataFrame([("ACME", d, 1.0) for d in weekdays(10)], SCHEMA)
    close = dt.datetime(2024, 1, 3, 21, 0)  # 16:00 in New York
    rows = [
        (1, "ACME", close - dt.timedelta(seconds=1)), (2, "ACME", close), (3, "ACME", dt.datetime(2024, 1, 6, 12)),
        (4, "ACME", dt.datetime(2023, 12, 1)), (5, "ACME", dt.datetime(2025, 1, 1)),
    ]
    events = spark.createDataFrame(rows, "id long, symbol string, published_at timestamp")
    got = {r["id"]: r["day0"] for r in market.first_session_after(events, market.session_calendar(prices)).collect()}
    d = dt.date
    assert got == {1: d(2024, 1, 3), 2: d(2024, 1, 4), 3: d(2024, 1, 8), 4: d(2024, 1, 1), 5: None}


def merged(spark, stored, fetched):
    make = lambda rows: spark.createDataFrame([("A", d, c) for d, c in rows], SCHEMA)
    return {r["date"]: r["close"] for r in market.merge_prices(make(stored), make(fetched)).collect()}


def test_restated_history_is_halved(spark):
    days = weekdays(41)
    stored = [(d, 100.0 + i) for i, d in enumerate(days[:40])]
    fetched = [(d, (100.0 + i) / 2) for i, d in enumerate(days)][20:]
    got = merged(spark, stored, fetched)
    assert got == pytest.approx({d: (100.0 + i) / 2 for i, d in enumerate(days)})


def test_small_revisions_touch_the_last_sessions_only(spark):
    days = weekdays(20)
    got = merged(spark, [(d, 100.0) for d in days], [(d, 100.1) for d in days])
    assert [got[d] for d in days] == [100.0] * 15 + [100.1] * 5


def test_ratio_is_the_upper_median(spark):
    days = weekdays(2)
    make = lambda a, b: spark.createDataFrame([("A", days[0], a), ("A", days[1], b)], SCHEMA)
    assert market.restatement_ratio(make(1.0, 3.0), make(1.0, 1.0)).first()["ratio"] == 3.0


def test_mean_ci(spark):
    df = spark.createDataFrame([("x", 0.01), ("x", 0.02), ("x", 0.03), ("y", 0.5)], "g string, v double")
    got = {r["g"]: r for r in market.mean_ci(df, ["g"], "v").collect()}
    half = 4.303 * 0.01 / math.sqrt(3)
    assert (got["x"]["mean"], got["x"]["lo"], got["x"]["hi"]) == (0.02, round(0.02 - half, 5), round(0.02 + half, 5))
    assert (got["y"]["n"], got["y"]["lo"]) == (1, None)


def test_zero_price_yields_no_return(spark):
    d = weekdays(4)
    rets = market.returns(spark.createDataFrame([("A", d[0], 1.0), ("A", d[1], 0.0), ("A", d[2], 2.0), ("A", d[3], 3.0)], SCHEMA))
    assert {r["date"]: r["ret"] for r in rets.collect()} == {d[1]: -1.0, d[3]: 0.5}


def test_constant_benchmark_has_beta_zero(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 4.0), ("a", 1.0, 3.0), ("b", 1.0, 1.0), ("b", 2.0, 2.0)], "g string, x double, y double")
    got = {r["g"]: r for r in market.ols(df, ["g"], "x", "y").collect()}
    assert (got["a"]["beta"], got["a"]["alpha"]) == (0.0, 3.0) and got["b"]["sigma"] is None


def test_weekly_events_count_once(spark):
    rows = [
        ("w", "t1", "A", START, "ok", 0.1, 2.0, 1, 50.0, 0.6), ("w", "t1", "A", START, "ok", 0.1, 2.0, 2, 60.0, 0.6),
        ("w", "t2", "A", START, "ok", 0.1, 2.0, 3, 40.0, 0.6), ("w", "t1", "B", START, "partial", 0.3, 9.0, 4, 90.0, 0.6),
    ]
    df = spark.createDataFrame(rows, "week string, topic string, symbol string, day0 date, status string, car double, t double, id long, total double, credibility double")
    events = market.week_events(df)
    assert {(r["topic"], r["id"]) for r in events.collect()} == {("t1", 2), ("t2", 3)}
    assert [(r["topic"], r["id"]) for r in market.unique_events(events).collect()] == [("t2", 3)]


def test_tracked_symbols(spark):
    df = spark.createDataFrame([("0700.HK",), ("NVDA",)], "symbol string")
    got = {r[0] for r in market.tracked_symbols(df, ["NVDA"], {"": "^GSPC", ".HK": "^HSI"}).collect()}
    assert got == {"0700.HK", "NVDA", "^GSPC", "^HSI"}


def test_price_files_later_rows_win(spark, tmp_path):
    from tidemark.sources.prices import read_prices, write_prices

    (tmp_path / "a.csv").write_text("symbol,date,close\nA,2024-01-01,1\nA,2024-01-02,2\nA,2024-01-01,3\n")
    (tmp_path / "b.csv").write_text("symbol,date,close\nA,2024-01-02,5\n")
    rows = read_prices(spark, str(tmp_path))
    assert {str(r["date"]): r["close"] for r in rows.collect()} == {"2024-01-01": 3.0, "2024-01-02": 5.0}
    write_prices(spark.createDataFrame([("A", START, 1234.56789), ("B", START, 0.000123456789)], SCHEMA), str(tmp_path / "out"))
    back = {r["symbol"]: r["close"] for r in read_prices(spark, str(tmp_path / "out")).collect()}
    assert back == pytest.approx({"A": 1234.57, "B": 0.000123457}, rel=1e-9)


def test_item_events_take_the_first_tickers(spark):
    items = spark.createDataFrame([(1, noon(weekdays(120)[100]), ["ACME", "X", "Y", "Z"])], "id long, published_at timestamp, tickers array<string>")
    rows = market.item_events(items, spark.createDataFrame(world(), SCHEMA), Settings()).orderBy("pos").collect()
    assert [(r["symbol"], r["status"]) for r in rows] == [("ACME", "ok"), ("X", "no-data"), ("Y", "no-data")]


def test_ols_survives_a_shift(spark):
    """Against a fit in long double on the same doubles; differences of large sums would lose the residuals."""
    import numpy as np

    rng = np.random.default_rng(4)
    x, noise = rng.normal(0, 1, 500), rng.normal(0, 1e-3, 500)
    rows, want = [], {}
    for name, shift in (("plain", 0.0), ("moved", 1e8), ("flat", None), ("two", 0.0)):
        xs = np.full(500, 3.0) if shift is None else x + shift
        ys = (2 * x + noise) + (shift or 0.0)
        xs, ys = (xs[:2], ys[:2]) if name == "two" else (xs, ys)
        rows += [(name, float(a), float(b)) for a, b in zip(xs, ys, strict=True)]
        a, b = xs.astype(np.longdouble), ys.astype(np.longdouble)
        dx, dy = a - a.mean(), b - b.mean()
        beta = (dx * dy).sum() / (dx * dx).sum() if (dx * dx).sum() > 0 else 0.0
        rss = ((dy - beta * dx) ** 2).sum()
        want[name] = (float(beta), float(np.sqrt(rss / (len(a) - 2))) if len(a) > 2 else None)
    rows += [(None, 1.0, 2.0), (None, 2.0, 4.0), (None, 3.0, 6.1), ("plain", None, 1.0)]
    found = {r.g: r for r in market.ols(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], "x", "y").collect()}
    assert found["plain"].n == 500 and found[None].n == 3
    for name, (beta, sigma) in want.items():
        assert found[name].beta == pytest.approx(beta, rel=1e-6)
        assert found[name].sigma is None if sigma is None else found[name].sigma == pytest.approx(sigma, rel=1e-4)
