"""Harvested feed items: normalise, merge by id, pick the lists of the digest."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import text, urls
from ..session import once
from .ranking import BLOCK, running_min

DEFAULT = Settings()
SIGNALS = ("hf_upvotes", "hn_points", "hn_comments", "hn_url")


def in_harvest_range(published: Column, now: Column, settings: Settings = DEFAULT) -> Column:
    """Published within the look-back and at most an hour ahead; unknown dates fail."""
    since = now - F.make_dt_interval(hours=F.lit(settings.since_hours))
    return F.coalesce(published.between(since, now + F.make_dt_interval(hours=F.lit(1))), F.lit(False))


def strip_outlet(title: Column, outlet: Column, kind: Column) -> Column:
    """Aggregator titles end in " - outlet"; drop it."""
    tail = F.concat(F.lit(" - "), outlet)
    cut_title = F.substring(title, F.lit(1), F.length(title) - F.length(tail))
    return F.when((kind == "gnews") & (outlet != "") & F.endswith(title, tail), cut_title).otherwise(title)


def normalise(rows: DataFrame, domains: Mapping[str, tuple[str, str]], settings: Settings = DEFAULT, unescape=text.html_unescape) -> DataFrame:
    """Parsed feed rows to raw items: clean texts, outlet fallback, tier, topical filter, id.

    rows: feed, kind, tier, lang, filter, feed_pos, row_pos, title, url, published_at, summary, outlet,
    outlet_url, signals."""
    cleaned = rows.withColumns({
        "title": text.clean_text(F.col("title"), settings.title_chars, unescape),
        "summary": text.clean_text(F.col("summary"), settings.summary_chars, unescape),
        "url": F.trim("url"),
    }).withColumn("title", strip_outlet(F.col("title"), F.col("outlet"), F.col("kind")))
    cleaned = once(cleaned, "__texts", F.struct("title", "summary")).withColumns({c: F.col(f"__texts.{c}") for c in ("title", "summary")}).drop("__texts")
    topical = text.is_topical(F.concat_ws(" ", "title", "summary"))
    kept = cleaned.filter(~F.col("filter") | topical)
    known = urls.with_known_domain(kept, "outlet_url", domains)
    by_outlet = (F.col("kind") == "gnews") & (F.coalesce("outlet_url", F.lit("")) != "")
    return known.select(
        urls.url_id(F.col("url")).alias("id"),
        "title", "url",
        F.coalesce(F.nullif("outlet", F.lit("")), "feed").alias("outlet"),
        "feed",
        F.when(by_outlet, F.coalesce("known_tier", F.lit("press"))).otherwise(F.col("tier")).alias("tier"),
        "lang", "published_at", "summary", F.col("kind").alias("via"), "signals", "feed_pos", "row_pos",
    )


def merge_by_id(items: DataFrame, position: str = "position", block: int = BLOCK) -> DataFrame:
    """One row per id: the earliest published (ties keep feed order), signals united.

    `position` is the row's place in feed order, an integer unique within the id. Folding the rows in
    that order, a row that becomes the kept one only fills missing signals, any other row overwrites
    them. So each signal is the last value among rows that were not kept when they came, else the
    first value at all: two aggregates, once the rows that lowered the minimum are marked."""
    marked = running_min(items, ["id"], position, "published_at", "__earlier", block)
    kept = F.col("__earlier").isNull() | (F.col("published_at") < F.col("__earlier"))
    columns = [c for c in items.columns if c not in ("id", "signals")]
    folded = []
    for s in SIGNALS:
        value = F.col(f"signals.{s}")
        late = F.when(value.isNotNull() & ~kept, F.col(position))
        early = F.when(value.isNotNull(), F.col(position))
        folded.append(F.coalesce(F.max_by(value, late), F.min_by(value, early)).alias(s))
    merged = marked.groupBy("id").agg(
        F.min_by(F.struct(*columns), F.struct("published_at", position)).alias("best"), *folded
    )
    return merged.select("id", "best.*", F.struct(*SIGNALS).alias("signals"))


def newest_first() -> list[Column]:
    return [F.col("published_at").desc(), F.col("id").desc()]


def primary_list(items: DataFrame, k: int = 25) -> DataFrame:
    """The newest items of primary sources that are not papers."""
    return items.filter((F.col("tier") == "primary") & (F.col("via") != "hf")).orderBy(*newest_first()).limit(k)


def top_by_signal(items: DataFrame, via: str, signal: str, k: int = 12) -> DataFrame:
    """Papers by upvotes or stories by points; ties keep the newest first."""
    return items.filter(F.col("via") == via).orderBy(F.coalesce(F.col(signal), F.lit(0)).desc(), *newest_first()).limit(k)


def feed_outcomes(attempts: DataFrame, kept: DataFrame) -> DataFrame:
    """Per feed: ok if any of its pages parsed, the last error otherwise (at most 200 characters), and
    the number of kept rows.

    attempts: feed, url_pos, ok, error. kept: feed."""
    tries = attempts.groupBy("feed").agg(
        F.bool_or("ok").alias("ok"), F.max_by("error", F.when(~F.col("ok"), F.col("url_pos"))).alias("error")
    )
    n = kept.groupBy("feed").agg(F.count(F.lit(1)).alias("kept"))
    return tries.join(n, "feed", "left").select(
        "feed", "ok",
        F.when(F.col("ok"), F.coalesce("kept", F.lit(0))).otherwise(F.lit(0)).alias("n"),
        F.when(~F.col("ok"), F.substring("error", 1, 200)).alias("error"),
    )


def staleness(harvested_at: Column, now: Column) -> Column:
    """Hours since the harvest."""
    return (F.unix_seconds(now) - F.unix_seconds(harvested_at)) / F.lit(3600.0)


