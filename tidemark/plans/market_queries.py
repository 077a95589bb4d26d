"""Prices and the event study: part brands as symbols, weekly average unit prices as closes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import BENCHMARKS, WATCHLIST
from ..functions import markets
from ..operators import market
from ..session import cut
from . import bindings as b
from .registry import cte, query

_SUFFIX_SQL = "CASE CAST(regexp_extract({0}, '(\\d+)', 1) AS INTEGER) % 3 WHEN 0 THEN '' WHEN 1 THEN '.HK' ELSE '.T' END"
cte("quotes", f"""
SELECT p_brand || {_SUFFIX_SQL.format('p_brand')} AS symbol, CAST(date_trunc('week', l_shipdate) AS DATE) AS date,
       avg(l_extendedprice / l_quantity) AS close
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
""")
cte("index_quotes", f"""
SELECT CASE {_SUFFIX_SQL.format('p_brand')} WHEN '' THEN '^GSPC' WHEN '.HK' THEN '^HSI' ELSE '^N225' END AS symbol,
       CAST(date_trunc('week', l_shipdate) AS DATE) AS date, avg(l_extendedprice / l_quantity) AS close
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL
""")
cte("prices", "SELECT * FROM quotes UNION ALL SELECT * FROM index_quotes")
cte("rets", """
SELECT symbol, date, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY date), 0) - 1 AS ret FROM prices QUALIFY ret IS NOT NULL
""")
_BENCH_SQL = "CASE WHEN ends_with({0}, '.HK') THEN '^HSI' WHEN ends_with({0}, '.T') THEN '^N225' ELSE '^GSPC' END"
cte("aligned", f"""
SELECT s.symbol, s.date, s.ret AS rs, m.ret AS rb, row_number() OVER (PARTITION BY s.symbol ORDER BY s.date) AS k
FROM rets s JOIN rets m ON m.date = s.date AND m.symbol = CASE WHEN s.symbol IN ('^GSPC', '^HSI', '^N225') THEN s.symbol ELSE {_BENCH_SQL.format('s.symbol')} END
""")
cte("study", """
SELECT symbol, date, n_est, alpha, beta, CASE WHEN n_ar = 3 THEN 'ok' ELSE 'partial' END AS progress, n_ar,
       (a0 + coalesce(a1, 0)) + coalesce(a2, 0) AS car, sqrt(greatest(0, syy - beta * sxy) / nullif(n_est - 2, 0)) AS sigma
FROM (SELECT *, rs - (alpha + beta * rb) AS a0, rs1 - (alpha + beta * rb1) AS a1, rs2 - (alpha + beta * rb2) AS a2,
             1 + (rs1 IS NOT NULL)::INTEGER + (rs2 IS NOT NULL)::INTEGER AS n_ar
      FROM (SELECT *, my - beta * mx AS alpha
            FROM (SELECT symbol, date, rs, rb, count(*) OVER w AS n_est, regr_syy(rs, rb) OVER w AS syy, regr_sxy(rs, rb) OVER w AS sxy,
                         avg(rs) OVER w AS my, avg(rb) OVER w AS mx, coalesce(regr_sxy(rs, rb) OVER w / nullif(regr_sxx(rs, rb) OVER w, 0), 0) AS beta,
                         lead(rs, 1) OVER o AS rs1, lead(rb, 1) OVER o AS rb1, lead(rs, 2) OVER o AS rs2, lead(rb, 2) OVER o AS rb2
                  FROM aligned WINDOW w AS (PARTITION BY symbol ORDER BY k ROWS BETWEEN 70 PRECEDING AND 11 PRECEDING),
                                      o AS (PARTITION BY symbol ORDER BY k))))
""")
cte("news", f"""
SELECT o_orderkey AS id, o_orderdate AS published_at, p_brand || {_SUFFIX_SQL.format('p_brand')} AS symbol, pos
FROM (SELECT l_orderkey, p_brand, row_number() OVER (PARTITION BY l_orderkey ORDER BY min(l_linenumber), p_brand) - 1 AS pos
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey, p_brand)
JOIN orders ON l_orderkey = o_orderkey WHERE pos < 3
""")
cte("closes", """
SELECT symbol, date AS session, CASE WHEN ends_with(symbol, '.HK') OR symbol = '^HSI' THEN CAST(timezone('Asia/Hong_Kong', date + INTERVAL 16 HOUR) AS TIMESTAMP)
  WHEN ends_with(symbol, '.T') OR symbol = '^N225' THEN CAST(timezone('Asia/Tokyo', date + INTERVAL '15:30' HOUR_MINUTE) AS TIMESTAMP)
  ELSE CAST(timezone('America/New_York', date + INTERVAL 16 HOUR) AS TIMESTAMP) END AS close_at
FROM prices
""".replace("INTERVAL '15:30' HOUR_MINUTE", "INTERVAL 930 MINUTE"))
cte("dated_news", """
SELECT n.*, (SELECT min(session) FROM closes c WHERE c.symbol = n.symbol AND c.close_at > n.published_at) AS day0 FROM news n
""")
cte("news_study", """
SELECT d.id, d.pos, d.symbol, CASE WHEN f.common IS NULL THEN 'pending' WHEN n_est < 48 THEN 'short-history' ELSE progress END AS status,
       coalesce(f.common, d.day0) AS day0, CASE WHEN n_est >= 48 THEN car END AS car,
       CASE WHEN n_est >= 48 AND sigma > 1e-12 THEN car / (sigma * sqrt(n_ar)) END AS t, CASE WHEN n_est >= 48 THEN beta END AS beta,
       CASE WHEN n_est >= 48 THEN n_ar ELSE 0 END AS n
FROM (SELECT d.*, (SELECT min(date) FROM aligned a WHERE a.symbol = d.symbol AND a.date >= d.day0) AS common FROM dated_news d) f
JOIN dated_news d ON d.id = f.id AND d.symbol = f.symbol LEFT JOIN study s ON s.symbol = f.symbol AND s.date = f.common
""")


def brand_suffix(brand) -> object:
    number = F.regexp_extract(brand, r"(\d+)", 1).cast("int")
    return b.one_of(number, ("", ".HK", ".T"))


def unit_prices(spark: SparkSession, sf: str) -> DataFrame:
    line = b.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.to_date(F.date_trunc("week", "l_shipdate")).alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )
    return line.join(b.table(spark, sf, "part").select("p_partkey", "p_brand"), "p_partkey")


def prices(spark: SparkSession, sf: str) -> DataFrame:
    """Brand quotes, and per exchange an index over all its brands."""
    rows = unit_prices(spark, sf).groupBy("p_brand", "date").agg(F.sum("unit_price").alias("s"), F.count(F.lit(1)).alias("n"))
    brand = F.concat("p_brand", brand_suffix(F.col("p_brand")))
    quotes = rows.select(brand.alias("symbol"), "date", (F.col("s") / F.col("n")).alias("close"))
    index = rows.groupBy(markets.benchmark_of(brand).alias("symbol"), "date").agg((F.sum("s") / F.sum("n")).alias("close"))
    return quotes.unionByName(index)


def tickers(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the brands of their lines, in line order, as tickers."""
    line = b.table(spark, sf, "lineitem").join(b.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    brands = line.groupBy(F.col("l_orderkey").alias("id"), "p_brand").agg(F.min("l_linenumber").alias("first_line"))
    lists = brands.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("first_line", "p_brand"))).alias("b")).select(
        "id", F.transform("b", lambda x: F.concat(x["p_brand"], brand_suffix(x["p_brand"]))).alias("tickers")
    )
    orders = b.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("timestamp").alias("published_at"))
    return lists.join(orders, "id")


def study(spark: SparkSession, sf: str) -> DataFrame:
    return market.item_events(tickers(spark, sf), cut(prices(spark, sf)), b.SETTINGS)


@query("w1_returns", "SELECT symbol, CAST(date AS VARCHAR) AS date, round(ret, 6) AS ret FROM rets")
def returns(spark: SparkSession, sf: str) -> DataFrame:
    return market.returns(prices(spark, sf)).select("symbol", b.day_text(F.col("date")).alias("date"), F.round("ret", 6).alias("ret"))


@query("w6_session_ordinal", """
SELECT symbol, CAST(date AS VARCHAR) AS date, k, greatest(k - 70, 1) AS first_k, greatest(k - 11, 0) AS last_k FROM aligned
""")
def session_ordinal(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions numbered per symbol, with the first and last ordinal of the estimation window."""
    return _aligned(spark, sf).select(
        "symbol", b.day_text(F.col("date")).alias("date"), F.col("k").cast("bigint").alias("k"),
        F.greatest(F.col("k") - 70, F.lit(1)).cast("bigint").alias("first_k"), F.greatest(F.col("k") - 11, F.lit(0)).cast("bigint").alias("last_k"),
    )


def _aligned(spark: SparkSession, sf: str) -> DataFrame:
    p = cut(prices(spark, sf))
    is_index = F.col("symbol").startswith("^")
    pairs = p.select("symbol").distinct().withColumn(
        "bench", F.when(is_index, F.col("symbol")).otherwise(markets.benchmark_of(F.col("symbol")))
    )
    return market.aligned_returns(market.returns(p), pairs)


@query("j7_benchmark_lookup", f"""
SELECT DISTINCT symbol, CASE WHEN ends_with(symbol, '.HK') THEN '.HK' WHEN ends_with(symbol, '.T') THEN '.T' ELSE '' END AS suffix,
       {_BENCH_SQL.format('symbol')} AS bench FROM quotes
""")
def benchmark_lookup(spark: SparkSession, sf: str) -> DataFrame:
    brands = b.table(spark, sf, "part").select(F.concat("p_brand", brand_suffix(F.col("p_brand"))).alias("symbol")).distinct()
    return brands.select("symbol", markets.symbol_suffix(F.col("symbol")).alias("suffix"), markets.benchmark_of(F.col("symbol")).alias("bench"))


@query("f13_symbol_suffix", """
SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '.HK' WHEN 1 THEN '' WHEN 2 THEN '.KS' ELSE '.T' END AS suffix,
       CASE p_size % 4 WHEN 0 THEN '^HSI' WHEN 1 THEN '^GSPC' WHEN 2 THEN '^KS11' ELSE '^N225' END AS bench FROM part
""")
def symbol_suffix(spark: SparkSession, sf: str) -> DataFrame:
    """Known, unknown and index symbols made from the part size."""
    tail = b.one_of(F.col("p_size"), (".HK", ".XX", ".KS", ""))
    stem = F.when(F.col("p_size") % 4 == 3, F.lit("^N225")).otherwise(F.upper(F.replace("p_brand", F.lit("#"), F.lit(""))))
    symbol = F.concat(stem, tail)
    return b.table(spark, sf, "part").select(
        "p_partkey", markets.symbol_suffix(symbol).alias("suffix"), markets.benchmark_of(symbol).alias("bench")
    )


_T_SQL = """CASE WHEN n - 1 < 1 THEN NULL WHEN n - 1 > 30 THEN 1.96 ELSE
  [12.706,4.303,3.182,2.776,2.571,2.447,2.365,2.306,2.262,2.228,2.179,2.179,2.131,2.131,2.131,2.086,2.086,2.086,2.086,2.086,2.060,2.060,2.060,2.060,2.060,2.042,2.042,2.042,2.042,2.042][n - 1] END"""


@query("f14_t_quantile", f"""
SELECT user_id, n, {_T_SQL}::DOUBLE AS t
FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id, event_type)
""")
def t_quantile(spark: SparkSession, sf: str) -> DataFrame:
    n = b.table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    return n.select("user_id", "n", markets.t_quantile(F.col("n") - 1).alias("t"))


@query("j8_day_zero", """
SELECT id, pos, symbol, CAST(day0 AS VARCHAR) AS day0 FROM dated_news
""")
def day_zero(spark: SparkSession, sf: str) -> DataFrame:
    p = cut(prices(spark, sf))
    named = tickers(spark, sf).select("id", "published_at", F.posexplode(F.slice("tickers", 1, 3)).alias("pos", "symbol"))
    return market.first_session_after(named, market.session_calendar(p)).select(
        "id", F.col("pos").cast("bigint").alias("pos"), "symbol", b.day_text(F.col("day0")).alias("day0")
    )


@query("j9_return_alignment", "SELECT symbol, CAST(date AS VARCHAR) AS date, round(rs, 6) AS rs, round(rb, 6) AS rb FROM aligned")
def return_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return _aligned(spark, sf).select(
        "symbol", b.day_text(F.col("date")).alias("date"), F.round("rs", 6).alias("rs"), F.round("rb", 6).alias("rb")
    )


@query("a13_ols", """
SELECT symbol, count(*) AS n, round(avg(rs) - regr_slope(rs, rb) * avg(rb), 6) AS alpha, round(regr_slope(rs, rb), 6) AS beta,
       round(sqrt(greatest(0, regr_syy(rs, rb) - regr_slope(rs, rb) * regr_sxy(rs, rb)) / (count(*) - 2)), 6) AS sigma
FROM aligned WHERE symbol NOT LIKE '^%' GROUP BY symbol
""")
def ols(spark: SparkSession, sf: str) -> DataFrame:
    rows = _aligned(spark, sf).filter(~F.col("symbol").startswith("^"))
    fit = market.ols(rows, ["symbol"], "rb", "rs")
    return fit.select("symbol", "n", *[F.round(c, 6).alias(c) for c in ("alpha", "beta", "sigma")])


@query("a13_ols_shifted", """
WITH s AS (SELECT symbol, rb + 1e8 AS x, rs + 1e8 AS y FROM aligned WHERE symbol NOT LIKE '^%'),
m AS (SELECT symbol, count(*) AS n, avg(x - 1e8) + 1e8 AS mx, avg(y - 1e8) + 1e8 AS my FROM s GROUP BY symbol),
c AS (SELECT symbol, n, mx, my, sum((x - mx) * (y - my)) / sum((x - mx) * (x - mx)) AS beta FROM s JOIN m USING (symbol) GROUP BY ALL)
SELECT symbol, n, round(beta, 4) AS beta, round(sqrt(sum(pow(y - my - beta * (x - mx), 2)) / (n - 2)), 5) AS sigma FROM s JOIN c USING (symbol) GROUP BY symbol, n, beta
""")
def ols_shifted(spark: SparkSession, sf: str) -> DataFrame:
    """The same returns moved by 1e8: slope and residuals must not be lost to cancellation."""
    rows = _aligned(spark, sf).filter(~F.col("symbol").startswith("^"))
    moved = rows.select("symbol", (F.col("rb") + 1e8).alias("x"), (F.col("rs") + 1e8).alias("y"))
    return market.ols(moved, ["symbol"], "x", "y").select("symbol", "n", F.round("beta", 4).alias("beta"), F.round("sigma", 5).alias("sigma"))


_STUDY_SQL = """
SELECT id, pos, symbol, status, CAST(day0 AS VARCHAR) AS day0, round(car, 5) AS car, round(t, 4) AS t, round(beta, 4) AS beta, CAST(n AS BIGINT) AS n
FROM news_study
"""


def _study_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id", F.col("pos").cast("bigint").alias("pos"), "symbol", "status", b.day_text(F.col("day0")).alias("day0"),
        F.round("car", 5).alias("car"), F.round("t", 4).alias("t"), F.round("beta", 4).alias("beta"), F.col("n").cast("bigint").alias("n"),
    )


@query("a14_event_study", _STUDY_SQL + " WHERE pos = 0")
def event_study(spark: SparkSession, sf: str) -> DataFrame:
    return _study_columns(study(spark, sf).filter("pos = 0"))


@query("j16_item_events", _STUDY_SQL)
def item_events(spark: SparkSession, sf: str) -> DataFrame:
    return _study_columns(study(spark, sf))


@query("a15_mean_ci", f"""
SELECT symbol, n, round(m, 5) AS mean, round(m - half, 5) AS lo, round(m + half, 5) AS hi
FROM (SELECT *, CASE WHEN n > 1 THEN ({_T_SQL}) * sd / sqrt(n) END AS half
      FROM (SELECT symbol, count(car) AS n, avg(car) AS m, stddev_samp(car) AS sd FROM news_study WHERE status = 'ok' GROUP BY symbol) WHERE n > 0)
""")
def mean_ci(spark: SparkSession, sf: str) -> DataFrame:
    return market.mean_ci(study(spark, sf).filter("status = 'ok'"), ["symbol"], "car")


cte("week_stories", """
SELECT strftime(published_at, '%G-W%V') AS week, topic, symbol, day0, status, car, t, s.id, total, credibility
FROM news_study n JOIN scored_week s ON s.id = n.id
""")
cte("week_events", """
SELECT week, topic, symbol, day0, first(id ORDER BY total DESC, credibility DESC, id) AS id, first(round(car, 5) ORDER BY total DESC, credibility DESC, id) AS car,
       first(round(t, 4) ORDER BY total DESC, credibility DESC, id) AS t
FROM week_stories WHERE status = 'ok' GROUP BY week, topic, symbol, day0
""")
cte("unique_events", "SELECT week, symbol, day0, last(t ORDER BY topic) AS t, last(topic ORDER BY topic) AS topic FROM week_events GROUP BY week, symbol, day0")


def week_events(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.times import week_id

    scored = b.scored(spark, sf).select("id", "topic", week_id(F.to_date("published_at")).alias("week"), "total", "credibility")
    events = study(spark, sf).select("id", "symbol", "day0", "status", F.round("car", 5).alias("car"), F.round("t", 4).alias("t"))
    return market.week_events(events.join(scored, "id"))


@query("a16_weekly_market", """
SELECT week, topic, count(*) AS n, round(avg(car), 10) AS mean,
       CASE WHEN count(*) > 1 THEN round(avg(car) - tq * stddev_samp(car) / sqrt(count(*)), 10) END AS lo,
       CASE WHEN count(*) > 1 THEN round(avg(car) + tq * stddev_samp(car) / sqrt(count(*)), 10) END AS hi
FROM (SELECT *, count(*) OVER (PARTITION BY week, topic) AS c, CASE WHEN c - 1 > 30 THEN 1.96 WHEN c > 1 THEN
  [12.706,4.303,3.182,2.776,2.571,2.447,2.365,2.306,2.262,2.228,2.179,2.179,2.131,2.131,2.131,2.086,2.086,2.086,2.086,2.086,2.060,2.060,2.060,2.060,2.060,2.042,2.042,2.042,2.042,2.042][c - 1] END::DOUBLE AS tq
  FROM week_events) GROUP BY week, topic, tq
""")
def weekly_market(spark: SparkSession, sf: str) -> DataFrame:
    """Unrounded on purpose: means of few five-digit values often end in a tie."""
    return market.mean_ci(week_events(spark, sf), ["week", "topic"], "car", digits=10)


@query("a16_weekly_market_top", """
SELECT week, CAST(rn AS BIGINT) AS rn, symbol, CAST(day0 AS VARCHAR) AS day0, topic, t, n_events FROM (
  SELECT *, row_number() OVER (PARTITION BY week ORDER BY abs(coalesce(t, 0)) DESC, symbol, day0) AS rn, count(*) OVER (PARTITION BY week) AS n_events
  FROM unique_events) WHERE rn <= 8
""")
def weekly_market_top(spark: SparkSession, sf: str) -> DataFrame:
    unique = cut(market.unique_events(week_events(spark, sf)))
    n = unique.groupBy("week").agg(F.count(F.lit(1)).alias("n_events"))
    return market.largest_moves(unique).join(n, "week").select(
        "week", F.col("rn").cast("bigint").alias("rn"), "symbol", b.day_text(F.col("day0")).alias("day0"), "topic", "t", "n_events"
    )


# Fetched again: later weeks only, restated by half for every other brand, with new prices at the end.
cte("refetched", """
SELECT symbol, date, close / CASE WHEN ascii(right(regexp_extract(symbol, '^[^.]*'), 1)) % 2 = 0 THEN 2 ELSE 1.001 END AS close
FROM quotes WHERE date >= DATE '2001-01-01'
""")
cte("kept_quotes", "SELECT * FROM quotes WHERE date < DATE '2001-08-01'")
cte("ratios", """
SELECT symbol, list_sort(list(r))[len(list(r)) // 2 + 1] AS ratio
FROM (SELECT s.symbol, s.close / f.close AS r, row_number() OVER (PARTITION BY s.symbol ORDER BY s.date DESC) AS rn
      FROM kept_quotes s JOIN refetched f ON f.symbol = s.symbol AND f.date = s.date) WHERE rn <= 20 GROUP BY symbol
""")
cte("merged_quotes", """
SELECT coalesce(s.symbol, f.symbol) AS symbol, coalesce(s.date, f.date) AS date,
       CASE WHEN f.rn <= 5 OR s.close IS NULL THEN f.close ELSE s.close END AS close
FROM (SELECT k.symbol, date, CASE WHEN abs(ratio - 1) > 0.005 THEN close / ratio ELSE close END AS close FROM kept_quotes k LEFT JOIN ratios r ON r.symbol = k.symbol) s
FULL JOIN (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM refetched) f ON f.symbol = s.symbol AND f.date = s.date
""")


def stored_and_fetched(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    quotes = cut(prices(spark, sf).filter(~F.col("symbol").startswith("^")))
    last_digit = F.ascii(F.right(F.regexp_extract("symbol", "^[^.]*", 0), F.lit(1)))
    restated = F.when(last_digit % 2 == 0, F.lit(2.0)).otherwise(F.lit(1.001))
    fetched = quotes.filter("date >= DATE'2001-01-01'").withColumn("close", F.col("close") / restated)
    return quotes.filter("date < DATE'2001-08-01'"), fetched


@query("a17_restatement_ratio", "SELECT symbol, round(ratio, 6) AS ratio FROM ratios")
def restatement_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return market.restatement_ratio(*stored_and_fetched(spark, sf)).withColumn("ratio", F.round("ratio", 6))


@query("j15_price_merge", "SELECT symbol, CAST(date AS VARCHAR) AS date, CAST(floor(close * 10000 + 0.3137) AS BIGINT) AS close_e4 FROM merged_quotes")
def price_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Closes in units of 1e-4, cut off between the ties that averages of cents often hit."""
    return market.merge_prices(*stored_and_fetched(spark, sf)).select(
        "symbol", b.day_text(F.col("date")).alias("date"), F.floor(F.col("close") * 10000 + 0.3137).alias("close_e4")
    )


@query("u5_new_dates", """
SELECT symbol, count(*) AS n_new FROM refetched f WHERE NOT EXISTS (SELECT 1 FROM kept_quotes k WHERE k.symbol = f.symbol AND k.date = f.date) GROUP BY symbol
""")
def new_dates(spark: SparkSession, sf: str) -> DataFrame:
    return market.new_dates(*stored_and_fetched(spark, sf))


def _symbols_sql() -> str:
    fixed = sorted({*WATCHLIST, *BENCHMARKS.values()})
    return f"""
SELECT unnest({b.sql_list(fixed)}) AS symbol UNION SELECT symbol FROM quotes UNION SELECT {_BENCH_SQL.format('symbol')} FROM quotes
"""


@query("s14_tracked_symbols", _symbols_sql())
def tracked_symbols(spark: SparkSession, sf: str) -> DataFrame:
    named = tickers(spark, sf).select(F.explode("tickers").alias("symbol"))
    return market.tracked_symbols(named, list(WATCHLIST), BENCHMARKS)


@query("u4_symbol_union", """
SELECT DISTINCT symbol FROM (SELECT p_brand AS symbol FROM part UNION ALL SELECT 'S' || s_suppkey % 50 FROM supplier)
""")
def symbol_union(spark: SparkSession, sf: str) -> DataFrame:
    brands = b.table(spark, sf, "part").select(F.col("p_brand").alias("symbol"))
    others = b.table(spark, sf, "supplier").select(F.concat(F.lit("S"), (F.col("s_suppkey") % 50).cast("string")).alias("symbol"))
    return brands.union(others).distinct()
