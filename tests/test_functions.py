import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import markets, scores, text, times, urls


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("url, want", [
    ("http://www.Example.com/a/b/?utm_source=x&id=3#frag", "https://example.com/a/b?id=3"),
    ("https://user:pw@Host.org:8080", "https://host.org/"),
    ("https://h.org/p?b=2&a=1&a=0&empty=&flag", "https://h.org/p?a=0&a=1&b=2"),
    ("https://h.org/p?q=a%20b&r=~*", "https://h.org/p?q=a+b&r=~%2A"),
    ("https://h.org/p?q=%zz", "https://h.org/p?q=%25zz"),
    ("https://h.org/p?ref=1&from=2&referrer=3&SHARE_id=4", "https://h.org/p?referrer=3"),
    ("  https://h.org//x//  ", "https://h.org//x"),
])
def test_canonical_url(spark, url, want):
    assert one(spark, urls.canonical_url(F.col("u")), u=url) == want


def test_domain(spark):
    assert one(spark, urls.domain_of(F.col("u")), u="https://www.News.Example.co.uk:443/x") == "news.example.co.uk"


def test_title_tokens(spark):
    got = one(spark, text.title_tokens(F.col("t")), t="The GPT-5.1 model says: Qwen 模型 is up, up to 2.5x")
    assert set(got) == {"gpt-5.1", "model", "qwen", "模", "型", "2.5x"}


def test_cluster_tokens(spark):
    got = one(spark, text.cluster_tokens(F.col("t")), t="A report: X buys 大模型 unit, says CEO")
    assert set(got) == {"buys", "unit", "ceo", "大模", "模型"}


def test_jaccard(spark):
    assert one(spark, text.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c")))) == pytest.approx(1 / 3)
    empty = F.array().cast("array<string>")
    assert one(spark, text.jaccard(empty, empty)) == 0.0


def test_clean_text(spark):
    assert one(spark, text.clean_text(F.col("t"), 10), t="<p>A &amp; B&nbsp;</p>\n c") == "A & B c"
    assert one(spark, text.clean_text(F.col("t"), 6), t="abcd efgh") == "abcd…"


def test_topical_quirk(spark):
    assert one(spark, text.is_topical(F.col("t")), t="she said so") is True
    assert one(spark, text.is_topical(F.col("t"), strict=True), t="she said so") is False
    assert one(spark, text.is_topical(F.col("t"), strict=True), t="new GPT-5 model") is True
    assert one(spark, text.is_topical(F.col("t"), strict=True), t="新的大模型") is True


def test_first_sentence(spark):
    assert one(spark, text.first_sentence(F.col("t")), t="Costs 3.5 m.  Next one.") == "Costs 3.5 m."
    assert one(spark, text.first_sentence(F.col("t")), t="e.g. this. not split") == "e.g. this. not split"


def test_keyword_hits_start_words(spark):
    hits = text.keyword_hits(F.col("t"), ["eval", "a/b", "pass@"])
    assert one(spark, hits, t="Evaluation of A/B tests, medieval") == ["eval", "a/b"]
    assert one(spark, hits, t="medieval") == []


@pytest.mark.parametrize("value, want", [
    ("Mon, 01 Jan 2024 10:00:00 GMT", "2024-01-01T10:00:00Z"),
    ("01 Jan 2024 10:00:00 +0800", "2024-01-01T02:00:00Z"),
    ("Mon, 1 Jan 2024 10:00:00 EST", "2024-01-01T15:00:00Z"),
    ("2024-01-01T10:00:00+08:00", "2024-01-01T02:00:00Z"),
    ("2024-01-01", "2024-01-01T00:00:00Z"),
    ("yesterday", None),
])
def test_feed_dates(spark, value, want):
    assert one(spark, times.fmt_ts(times.parse_feed_date(F.col("t"))), t=value) == want


def test_parse_ts_needs_a_zone(spark):
    assert one(spark, times.parse_ts(F.col("t")), t="2024-01-01T10:00:00") is None
    assert one(spark, times.fmt_ts(times.parse_ts(F.col("t"))), t="2024-01-01T10:00:00+02:00") == "2024-01-01T08:00:00Z"


@pytest.mark.parametrize("day", ["2027-01-01", "2026-12-31", "2024-12-30", "2021-01-03", "2020-02-29"])
def test_iso_weeks(spark, day):
    d = dt.date.fromisoformat(day)
    y, w, wd = d.isocalendar()
    week = times.week_id(F.lit(d))
    assert one(spark, week) == f"{y}-W{w:02d}"
    monday, sunday = times.week_bounds(week)
    assert one(spark, monday) == d - dt.timedelta(days=wd - 1)
    assert one(spark, sunday) == d + dt.timedelta(days=7 - wd)


def test_window_membership(spark):
    ts = lambda h: F.lit(f"2024-01-01 {h:02d}:00:00").cast("timestamp")
    for hour, want in ((3, (False, False)), (4, (False, True)), (10, (True, True)), (12, (True, True)), (13, (False, False))):
        inside, graced = times.in_window(ts(hour), ts(10), ts(12), 6)
        assert (one(spark, inside), one(spark, graced)) == want


def test_symbols(spark):
    for symbol, suffix, bench in (
        ("NVDA", "", "^GSPC"), ("0700.HK", ".HK", "^HSI"), ("BRK.B", "", "^GSPC"), ("^N225", ".T", "^N225"), ("600000.SS", ".SS", "000001.SS")
    ):
        assert one(spark, markets.symbol_suffix(F.lit(symbol))) == suffix
        assert one(spark, markets.benchmark_of(F.lit(symbol))) == bench


def test_close_follows_daylight_saving(spark):
    summer = times.fmt_ts(markets.close_utc(F.lit("AAPL"), F.lit("2024-07-01").cast("date")))
    winter = times.fmt_ts(markets.close_utc(F.lit("AAPL"), F.lit("2024-01-02").cast("date")))
    seoul = times.fmt_ts(markets.close_utc(F.lit("005930.KS"), F.lit("2024-01-02").cast("date")))
    assert (one(spark, summer), one(spark, winter), one(spark, seoul)) == (
        "2024-07-01T20:00:00Z", "2024-01-02T21:00:00Z", "2024-01-02T06:30:00Z")


def test_t_quantiles(spark):
    got = [one(spark, markets.t_quantile(F.lit(df))) for df in (0, 1, 10, 11, 30, 31)]
    assert got == [None, 12.706, 2.228, 2.179, 2.042, 1.96]


def test_curves(spark):
    assert one(spark, scores.breadth(F.lit(3), 3.0)) == pytest.approx(1 - math.exp(-1))
    assert one(spark, scores.momentum(F.lit(2), F.lit(0.0))) == pytest.approx(1 - math.exp(-2))
    assert one(spark, scores.damping(F.lit(None).cast("int"))) == 1.0
    assert one(spark, scores.gap_priority(F.lit(4.0), F.lit(3.0), F.lit(1.0))) == 0.0


def test_known_domain_prefers_the_longest_suffix(spark):
    dim = {"example.com": ("E", "press"), "blog.example.com": ("B", "primary")}
    rows = spark.createDataFrame(
        [("https://www.blog.example.com/x",), ("https://a.example.com/",), ("https://other.org",), ("https://a.blog.example.com",)], ["u"]
    )
    got = {r["u"]: r["known_tier"] for r in urls.with_known_domain(rows, "u", dim).collect()}
    assert list(got[r["u"]] for r in rows.collect()) == ["primary", "press", None, "primary"]


def test_canonical_url_by_columns_runs_each_pattern_once(spark):
    given = [None, "", " http://u:p@x@WWW.A.com:80//b//?ref=1&b=2&a=%20*#f?x=1 ", "HTTP://h:1:2", "//h/?&=3", "h/a?q=1", "https://h?utm_x=1#"]
    df = urls.with_canonical_url(spark.createDataFrame([(u,) for u in given], "u string"), F.col("u"), "c")
    assert df.columns == ["u", "c"]
    assert [r.c for r in df.collect()] == [r.c for r in df.select(urls.canonical_url(F.col("u")).alias("c")).collect()]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("://)?([^/?#]") <= 1
    assert [r.d for r in df.select(urls.domain_of(F.col("u")).alias("d")).collect()] == [None, "", "a.com", "h:1", "h", "", "h"]
