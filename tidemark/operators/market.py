"""Price store and market-model event study.

A series has at most one row per session, so windows over a symbol are bounded by the calendar. The
study is computed once per (symbol, session) with such windows; stories only look their row up. A
symbol named by a third of all stories therefore costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import BENCHMARKS, Settings
from ..functions import markets

DEFAULT = Settings()


def latest_load(prices: DataFrame, order: str = "load_seq") -> DataFrame:
    """One close per (symbol, date): the one loaded last."""
    return prices.groupBy("symbol", "date").agg(F.max_by("close", order).alias("close"))


def returns(prices: DataFrame) -> DataFrame:
    """Simple returns over consecutive sessions of a symbol; a zero price before yields no row."""
    by_symbol = Window.partitionBy("symbol").orderBy("date")
    before = F.nullif(F.lag("close").over(by_symbol), F.lit(0.0))
    return prices.withColumn("ret", F.col("close") / before - F.lit(1.0)).filter("ret is not null").select("symbol", "date", "ret")


def tracked_symbols(tickers: DataFrame, watchlist: list[str], benchmarks: dict[str, str] = BENCHMARKS) -> DataFrame:
    """Watchlist, benchmarks, archived tickers and the benchmark of each, once."""
    spark = tickers.sparkSession
    fixed = spark.createDataFrame([(s,) for s in {*watchlist, *benchmarks.values()}], "symbol string")
    named = fixed.union(tickers.select("symbol")).distinct()
    return named.union(named.select(markets.benchmark_of(F.col("symbol"), benchmarks))).distinct()


def new_dates(stored: DataFrame, fetched: DataFrame) -> DataFrame:
    """Fetched sessions that are not stored yet, counted per symbol."""
    fresh = fetched.join(stored.select("symbol", "date"), ["symbol", "date"], "left_anti")
    return fresh.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_new"))


def restatement_ratio(stored: DataFrame, fetched: DataFrame, last: int = 20) -> DataFrame:
    """(symbol, ratio): upper median of stored / fetched over the last overlapping sessions."""
    both = stored.select("symbol", "date", F.col("close").alias("old")).join(
        fetched.select("symbol", "date", F.col("close").alias("new")), ["symbol", "date"]
    )
    recent = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    tail = both.withColumn("rn", F.row_number().over(recent)).filter(F.col("rn") <= last).filter("new <> 0")
    return tail.groupBy("symbol").agg(F.array_sort(F.collect_list(F.col("old") / F.col("new"))).alias("r")).select(
        "symbol", F.get("r", F.floor(F.size("r") / 2).cast("int")).alias("ratio")
    )


def merge_prices(stored: DataFrame, fetched: DataFrame, refresh_last: int = 5, tolerance: float = 0.005) -> DataFrame:
    """Upsert: history is divided by the restatement ratio when it is off, new sessions are added and
    the last fetched ones overwrite what is stored."""
    ratio = restatement_ratio(stored, fetched)
    recent = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    new = fetched.select("symbol", "date", F.col("close").alias("new"), (F.row_number().over(recent) <= refresh_last).alias("fresh"))
    old = stored.select("symbol", "date", F.col("close").alias("old")).join(ratio, "symbol", "left").select(
        "symbol", "date",
        F.when(F.abs(F.col("ratio") - 1) > tolerance, F.col("old") / F.col("ratio")).otherwise(F.col("old")).alias("old"),
    )
    return old.join(new, ["symbol", "date"], "full_outer").select(
        "symbol", "date", F.when(F.col("fresh") | F.col("old").isNull(), F.col("new")).otherwise(F.col("old")).alias("close")
    )


def price_rows(prices: DataFrame) -> DataFrame:
    """The price store as text rows: sorted, six significant digits."""
    return prices.select("symbol", "date", F.format_string("%.6g", "close").alias("close")).sort("symbol", "date")


def significant(value: Column, digits: int = 6) -> Column:
    """`value` rounded to significant digits."""
    scale = F.pow(F.lit(10.0), F.lit(digits - 1) - F.floor(F.log10(F.abs(value))))
    return F.when(value == 0, F.lit(0.0)).otherwise(F.round(value * scale) / scale)


def session_calendar(prices: DataFrame) -> DataFrame:
    """(symbol, session, close_at, prev_close_at, first): exchange-local closes as instants."""
    by_symbol = Window.partitionBy("symbol").orderBy("date")
    closes = prices.select("symbol", "date", markets.close_utc(F.col("symbol"), F.col("date")).alias("close_at"))
    return closes.select(
        "symbol", F.col("date").alias("session"), "close_at", F.lag("close_at").over(by_symbol).alias("prev_close_at")
    )


def first_session_after(events: DataFrame, calendar: DataFrame) -> DataFrame:
    """Add `day0`, the first session of the symbol that closes strictly after `published_at` (null when
    none does). A session is the answer for publications in [previous close, close); these intervals
    are cut by day, so the as-of join becomes an equi-join on (symbol, day)."""
    gaps = calendar.filter("prev_close_at is not null").select(
        "symbol", "session", "close_at", "prev_close_at",
        F.explode(F.sequence(F.to_date("prev_close_at"), F.to_date("close_at"))).alias("day"),
    )
    firsts = calendar.filter("prev_close_at is null").select(
        "symbol", F.col("session").alias("first_session"), F.col("close_at").alias("first_close")
    )
    e = events.withColumn("day", F.to_date("published_at")).alias("e")
    g = gaps.alias("g")
    inside = (
        (F.col("e.symbol") == F.col("g.symbol")) & (F.col("e.day") == F.col("g.day"))
        & (F.col("published_at") >= F.col("prev_close_at")) & (F.col("published_at") < F.col("close_at"))
    )
    met = e.join(g, inside, "left").select("e.*", "session").drop("day")
    return (
        met.join(firsts, "symbol", "left")
        .withColumn("day0", F.coalesce("session", F.when(F.col("published_at") < F.col("first_close"), F.col("first_session"))))
        .drop("session", "first_session", "first_close")
    )


def aligned_returns(rets: DataFrame, pairs: DataFrame) -> DataFrame:
    """(symbol, bench, date, rs, rb, k): sessions where both have a return, numbered per symbol. Each
    side's returns are over its own sessions. `pairs` holds (symbol, bench)."""
    stock = rets.select("symbol", "date", F.col("ret").alias("rs"))
    bench = rets.select(F.col("symbol").alias("bench"), "date", F.col("ret").alias("rb"))
    ordinal = Window.partitionBy("symbol").orderBy("date")
    return stock.join(pairs, "symbol").join(bench, ["bench", "date"]).withColumn("k", F.row_number().over(ordinal))


def fit(x: str, y: str, w) -> dict[str, Column]:
    """Least squares of y on x over a window: n, alpha, beta (0 for constant x) and residual sd (ddof 2)."""
    n = F.count(F.lit(1)).over(w)
    sxx, syy, sxy = (F.regr_sxx(y, x).over(w), F.regr_syy(y, x).over(w), F.regr_sxy(y, x).over(w))
    beta = F.coalesce(F.try_divide(sxy, sxx), F.lit(0.0))
    rss = F.greatest(F.lit(0.0), syy - beta * sxy)
    return {
        "n_est": n,
        "beta": beta,
        "alpha": F.avg(y).over(w) - beta * F.avg(x).over(w),
        "sigma": F.sqrt(F.try_divide(rss, F.greatest(n - 2, F.lit(0)))),
    }


def ols(df: DataFrame, group: list[str], x: str, y: str) -> DataFrame:
    """Least squares per group: n, alpha, beta, residual sd (null when n <= 2). Pairs with a null on either side are left out.

    Nothing is taken as the difference of large sums: the means are joined back, the slope comes from centred products, and
    the residuals themselves are squared and added up in a second pass. Each pass is an aggregation that starts on the map
    side; what is joined back is one row a group."""
    pairs = df.select(*group, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y")).filter("__x IS NOT NULL AND __y IS NOT NULL")
    means = pairs.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.avg("__x").alias("__mx"), F.avg("__y").alias("__my"))

    def back(rows: DataFrame, stats: DataFrame) -> DataFrame:
        names = {g: f"__of{i}" for i, g in enumerate(group)}
        other = stats.withColumnsRenamed(names)
        return rows.join(other, [F.col(g).eqNullSafe(F.col(n)) for g, n in names.items()]).drop(*names.values())

    dx, dy = F.col("__x") - F.col("__mx"), F.col("__y") - F.col("__my")
    centred = back(pairs, means).groupBy(*group, "n", "__mx", "__my").agg(F.sum(dx * dx).alias("__sxx"), F.sum(dx * dy).alias("__sxy"))
    lines = centred.withColumn("beta", F.coalesce(F.try_divide("__sxy", "__sxx"), F.lit(0.0)))
    residual = dy - F.col("beta") * dx
    summed = back(pairs, lines).groupBy(*group, "n", "__mx", "__my", "beta").agg(F.sum(residual * residual).alias("__rss"))
    return summed.select(
        *group, "n", (F.col("__my") - F.col("beta") * F.col("__mx")).alias("alpha"), "beta",
        F.sqrt(F.try_divide("__rss", F.greatest(F.col("n") - 2, F.lit(0)))).alias("sigma"),
    )


def study_table(aligned: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The study for every possible day 0: (symbol, date, status, ar, car, t, beta, n).

    Estimation over the `estimation_days` sessions that end `estimation_gap` before day 0, abnormal
    returns over the `car_days` sessions from day 0 on."""
    by_symbol = Window.partitionBy("symbol").orderBy("k")
    gap, length = settings.estimation_gap, settings.estimation_days
    w = by_symbol.rowsBetween(-(gap + length), -(gap + 1))
    fitted = aligned.withColumns(fit("rb", "rs", w))
    ar = []
    for j in range(settings.car_days):
        ar.append(F.lead("rs", j).over(by_symbol) - (F.col("alpha") + F.col("beta") * F.lead("rb", j).over(by_symbol)))
    fitted = fitted.withColumn("ar", F.array_compact(F.array(*ar)))
    enough = F.col("n_est") >= int(0.8 * length)
    n = F.size("ar")
    car = F.aggregate("ar", F.lit(0.0), lambda a, x: a + x)
    return fitted.select(
        "symbol", "bench", "date",
        F.when(~enough, "short-history").when(n == settings.car_days, "ok").otherwise("partial").alias("status"),
        F.when(enough, F.col("ar")).otherwise(F.array().cast("array<double>")).alias("ar"),
        F.when(enough, car).alias("car"),
        F.when(enough & (F.col("sigma") > 1e-12), F.try_divide(car, F.col("sigma") * F.sqrt(n))).alias("t"),
        F.when(enough, F.col("beta")).alias("beta"),
        F.when(enough, n).otherwise(0).alias("n"),
    )


def event_study(
    events: DataFrame, prices: DataFrame, settings: Settings = DEFAULT, benchmarks: dict[str, str] = BENCHMARKS
) -> DataFrame:
    """Events (symbol, published_at, ...) with bench, status, day0, ar, car, t, beta, n.

    status: no-data (no series), pending (no session after the publication yet), short-history, partial
    (fewer than car_days sessions so far) or ok. day0 is the first common session when there is one."""
    have = prices.select("symbol").distinct()
    pairs = have.withColumn("bench", markets.benchmark_of(F.col("symbol"), benchmarks))
    both = pairs.join(have.withColumnRenamed("symbol", "bench"), "bench", "left_semi")

    aligned = aligned_returns(returns(prices), both)
    study = study_table(aligned, settings)
    # The first common session on or after each session of the stock; one row per (symbol, session).
    onward = Window.partitionBy("symbol").orderBy("date").rowsBetween(0, Window.unboundedFollowing)
    common = (
        prices.select("symbol", "date").join(aligned.select("symbol", "date", F.col("date").alias("common")), ["symbol", "date"], "left")
        .select("symbol", F.col("date").alias("day0"), F.min("common").over(onward).alias("common"))
    )
    lookup = common.join(
        study.select("symbol", F.col("date").alias("common"), "status", "ar", "car", "t", "beta", "n"), ["symbol", "common"], "left"
    )
    dated = first_session_after(events.withColumn("bench", markets.benchmark_of(F.col("symbol"), benchmarks)), session_calendar(prices))
    has_data = both.select("symbol", F.lit(True).alias("has_data"))
    out = dated.join(has_data, "symbol", "left").join(lookup, ["symbol", "day0"], "left")
    known = F.coalesce("has_data", F.lit(False))
    return out.select(
        *[c for c in events.columns],
        "bench",
        F.when(~known, "no-data").otherwise(F.coalesce("status", F.lit("pending"))).alias("status"),
        F.when(known, F.coalesce("common", "day0")).alias("day0"),
        F.coalesce("ar", F.array().cast("array<double>")).alias("ar"),
        "car", "t", "beta", F.coalesce("n", F.lit(0)).alias("n"),
    )


def item_events(items: DataFrame, prices: DataFrame, settings: Settings = DEFAULT, benchmarks: dict[str, str] = BENCHMARKS) -> DataFrame:
    """The study for the first tickers of each item: id, symbol, pos and the study columns."""
    named = items.select("id", "published_at", F.posexplode(F.slice("tickers", 1, settings.max_tickers)).alias("pos", "symbol"))
    return event_study(named, prices, settings, benchmarks)


def mean_ci(df: DataFrame, group: list[str], value: str, digits: int = 5) -> DataFrame:
    """n, mean and 95% t-interval per group; the bounds are null for a single value."""
    stats = df.groupBy(*group).agg(
        F.count(value).alias("n"), F.avg(value).alias("m"), F.stddev_samp(value).alias("sd")
    ).filter("n > 0")
    half = F.when(F.col("n") > 1, markets.t_quantile(F.col("n") - 1) * F.col("sd") / F.sqrt("n"))
    return stats.select(
        *group, "n", *[F.round(c, digits).alias(n) for n, c in (("mean", F.col("m")), ("lo", F.col("m") - half), ("hi", F.col("m") + half))]
    )


def week_events(stories: DataFrame) -> DataFrame:
    """Completed events of a week, each (week, topic, symbol, day0) once with its best-ranked story.

    stories: week, topic, symbol, day0, status, car, t, id, total, credibility."""
    rank = F.struct(-F.col("total"), -F.col("credibility"), F.col("id"))
    return (
        stories.filter("status = 'ok'").groupBy("week", "topic", "symbol", "day0")
        .agg(F.min_by(F.struct("id", "car", "t"), rank).alias("s"))
        .select("week", "topic", "symbol", "day0", "s.*")
    )


def unique_events(events: DataFrame) -> DataFrame:
    """One row per (week, symbol, day0); the alphabetically last topic wins."""
    return (
        events.groupBy("week", "symbol", "day0").agg(F.max_by(F.struct("topic", "id", "car", "t"), "topic").alias("s"))
        .select("week", "symbol", "day0", "s.*")
    )


def largest_moves(unique: DataFrame, k: int = 8) -> DataFrame:
    """The k events of each week with the largest |t|."""
    from .ranking import top_in_group

    order = [F.abs(F.coalesce("t", F.lit(0.0))).desc(), F.col("symbol").asc(), F.col("day0").asc()]
    return top_in_group(unique, ["week"], order, k)
