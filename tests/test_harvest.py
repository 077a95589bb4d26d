import datetime as dt
import random

from pyspark.sql import functions as F

from tidemark.config import Settings
from tidemark.functions import times
from tidemark.operators import harvest
from tidemark.sources import payloads

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel>
<title>c</title><item><title>Chips &amp; GPUs - Out</title><link>http://x/1?utm_source=a</link><pubDate>Mon, 01 Jan 2024 00:00:00 GMT</pubDate><description>d</description><source url="https://www.out.com">Out</source></item>
<item><title>Model B</title><link>http://x/2</link><dc:date>2024-01-01T00:00:00Z</dc:date><content:encoded><![CDATA[<p>hey</p>]]></content:encoded><description>d2</description></item>
<item><title></title><link>http://x/3</link></item></channel></rss>"""
RDF = """<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>t</title></channel><item><title>R</title><link>http://r/1</link><dc:date>2024-01-02</dc:date><description>rd</description></item></rdf:RDF>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title><entry><title type="html">模型</title><link rel="self" href="http://no"/><link href="http://a/1"/><updated>2024-01-03T00:00:00Z</updated><content type="html">ct</content></entry></feed>"""
BROKEN = "<rss><channel><item><title>AT&T &nbsp; x\x07 &lt;b&gt; &#65; &unknown;</title><link>http://b/1?a=1&b=2</link></item></channel></rss>"
PAPERS = '[{"paper":{"id":"1","title":"P","upvotes":42},"publishedAt":"2024-01-01T00:00:00Z"},{"id":"2","title":"row","publishedAt":"2024-01-02T00:00:00Z"},{"title":"no id"}]'
STORIES = '{"hits":[{"objectID":"9","title":"S","url":null,"created_at_i":1704067200,"points":5,"num_comments":null}]}'


def parsed(spark):
    rows = [
        ("a", "gnews", 0, RSS), ("b", "rss", 0, RDF), ("c", "rss", 0, ATOM), ("d", "rss", 0, BROKEN), ("e", "rss", 0, "<html><p>"), ("e", "rss", 1, RDF),
        ("f", "hf", 0, PAPERS), ("g", "hn", 0, STORIES), ("h", "hn", 0, "oops"), ("h", "hn", 1, "oops again"),
    ]
    return payloads.parse_pages(spark.createDataFrame(rows, "feed string, kind string, url_pos int, payload string"))


def test_feeds_of_all_notations(spark):
    rows = {(r["feed"], r["title"]): r for r in payloads.feed_rows(parsed(spark)).collect()}
    assert set(rows) == {
        ("a", "Chips & GPUs - Out"), ("a", "Model B"), ("b", "R"), ("e", "R"), ("c", "模型"), ("d", "AT&T \xa0 x <b> A &unknown;"), ("f", "P"), ("f", "row"), ("g", "S"),
    }
    assert (rows["a", "Chips & GPUs - Out"]["outlet"], rows["a", "Chips & GPUs - Out"]["outlet_url"]) == ("Out", "https://www.out.com")
    assert (rows["a", "Model B"]["published"], rows["a", "Model B"]["summary"]) == ("2024-01-01T00:00:00Z", "<p>hey</p>")
    assert (rows["c", "模型"]["url"], rows["c", "模型"]["summary"]) == ("http://a/1", "ct")
    assert rows["d", "AT&T \xa0 x <b> A &unknown;"]["url"] == "http://b/1?a=1&b=2"
    assert rows["f", "P"]["signals"]["hf_upvotes"] == 42 and rows["f", "row"]["url"].endswith("/2")
    assert rows["g", "S"]["url"] == rows["g", "S"]["signals"]["hn_url"] and rows["g", "S"]["signals"]["hn_comments"] == 0


def test_a_feed_is_ok_when_one_page_parsed(spark):
    pages = parsed(spark)
    got = {r["feed"]: (r["ok"], r["n"], r["error"] is not None) for r in harvest.feed_outcomes(pages, payloads.feed_rows(pages)).collect()}
    assert got["a"] == (True, 2, False) and got["e"] == (True, 1, False) and got["h"] == (False, 0, True)


def test_normalise(spark):
    rows = payloads.feed_rows(parsed(spark)).filter("feed = 'a'").withColumns({
        "tier": F.lit("trade"), "lang": F.lit("en"), "filter": F.lit(True), "feed_pos": F.lit(0), "published_at": times.parse_feed_date(F.col("published")),
    })
    out = harvest.normalise(rows, {"out.com": ("Out", "primary")})
    got = {r["title"]: (r["outlet"], r["tier"], r["via"]) for r in out.collect()}
    assert got == {"Chips & GPUs": ("Out", "primary", "gnews")}  # the other one is off topic
    assert {len(r["id"]) for r in out.collect()} == {12}


def folded(rows):
    """Rows of one id in feed order, one after the other."""
    kept, signals = None, {}
    for r in rows:
        own = {k: v for k, v in r["signals"].items() if v is not None}
        if kept is None or r["published_at"] < kept["published_at"]:
            kept, signals = r, {**own, **signals}
        else:
            signals = {**signals, **own}
    return kept["tag"], signals


def test_merge_equals_the_fold(spark):
    rng = random.Random(9)
    rows = []
    for i in range(400):
        pick = lambda: rng.choice([None, rng.randint(0, 99)])
        rows.append({
            "id": rng.choice("abcdefgh"), "position": i, "tag": i, "published_at": dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.randint(0, 30)),
            "signals": {"hf_upvotes": pick(), "hn_points": pick(), "hn_comments": None, "hn_url": rng.choice([None, "u"])},
        })
    schema = "id string, position long, tag long, published_at timestamp, signals struct<hf_upvotes:bigint,hn_points:bigint,hn_comments:bigint,hn_url:string>"
    got = {
        r["id"]: (r["tag"], {k: v for k, v in r["signals"].asDict().items() if v is not None})
        for r in harvest.merge_by_id(spark.createDataFrame(rows, schema), block=16).collect()
    }
    assert got == {k: folded([r for r in rows if r["id"] == k]) for k in {r["id"] for r in rows}}


def test_range_and_staleness(spark):
    now = F.lit("2024-01-02 12:00:00").cast("timestamp")
    at = lambda t: F.lit(t).cast("timestamp")
    flags = [harvest.in_harvest_range(at(t), now).alias(f"c{i}") for i, t in enumerate(
        ["2024-01-01 00:00:00", "2023-12-31 23:59:59", "2024-01-02 13:00:00", "2024-01-02 13:00:01", None])]
    assert list(spark.range(1).select(*flags).first()) == [True, False, True, False, False]
    assert spark.range(1).select(harvest.staleness(at("2024-01-02 05:30:00"), now)).first()[0] == 6.5
    assert Settings().stale_hours == 6


def test_lists(spark):
    t = lambda h: dt.datetime(2024, 1, 1, h)
    df = spark.createDataFrame(
        [("a", t(1), "primary", "rss", None), ("b", t(2), "primary", "hf", 5), ("c", t(3), "press", "hf", 5), ("d", t(3), "primary", "rss", None)],
        "id string, published_at timestamp, tier string, via string, up long")
    assert [r["id"] for r in harvest.primary_list(df, 1).collect()] == ["d"]
    assert [r["id"] for r in harvest.top_by_signal(df, "hf", "up", 2).collect()] == ["c", "b"]


def test_prefixed_notations(spark):
    atom = '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>T &amp; x:y</a:title><a:link href="http://a/1"/><a:updated>2024-01-03T00:00:00Z</a:updated></a:entry></a:feed>'
    rss = "<rss xmlns:d.c='http://purl.org/dc/elements/1.1/'><channel><item><title>U</title><link>http://u/1</link><d.c:date>2024-01-04</d.c:date></item></channel></rss>"
    pages = payloads.parse_pages(spark.createDataFrame([("a", "rss", 0, atom), ("b", "rss", 0, rss)], "feed string, kind string, url_pos int, payload string"))
    got = {(r["title"], r["url"], r["published"]) for r in payloads.feed_rows(pages).collect()}
    assert got == {("T & x:y", "http://a/1", "2024-01-03T00:00:00Z"), ("U", "http://u/1", "2024-01-04")}


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_of_a_page_are_worked_out_once(spark):
    """an entry was parsed for each of its fields and again in filters, texts were cleaned in the filter and after it."""
    pages = spark.createDataFrame([("f", "rss", 0, "<rss><channel><item><title>t</title></item></channel></rss>")], "feed string, kind string, url_pos long, payload string")
    rows = payloads.feed_rows(payloads.parse_feed(pages))
    assert _plan(rows).count("from_xml") <= 6
    fields = rows.withColumns({"tier": F.lit("press"), "lang": F.lit("de"), "filter": F.col("url_pos") > 0, "feed_pos": F.lit(0), "published_at": F.current_timestamp()})
    assert _plan(harvest.normalise(fields, {})).count("ArrowEvalPython") <= 1
