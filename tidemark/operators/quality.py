"""Data-quality rules. A rule is a condition on a row; violations come out as rows.

All rules of a row are checked in one pass: an array with a struct per broken rule is exploded, so a
table of any size needs one projection. Rules that need several rows (duplicate ids, references,
facts about an item's sources) are joins and aggregations.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CONFIDENCE, LANGS, REGIONS, TIERS, TOPICS, UPCOMING_KINDS, Settings
from ..functions import times, urls

DEFAULT = Settings()

# --- fixed values: patterns of ids, addresses and event dates ---------------------------
ID_PATTERN = r"^[a-z0-9]+(?:-[a-z0-9]+)*$"
URL_PATTERN = r"^https?://[^\s/$.?#][^\s]*$"
DAY_PATTERN = r"^\d{4}-\d{2}(-\d{2})?$"


def error(name: str, broken: Column) -> Column:
    return F.when(broken, F.struct(F.lit(name).alias("rule"), F.lit("error").alias("severity")))


def warning(name: str, broken: Column) -> Column:
    return F.when(broken, F.struct(F.lit(name).alias("rule"), F.lit("warning").alias("severity")))


def violations(df: DataFrame, keys: Sequence[str], rules: Sequence[Column]) -> DataFrame:
    """keys, rule, severity: one row per broken rule."""
    return df.select(*keys, F.explode(F.array_compact(F.array(*rules))).alias("v")).select(*keys, "v.*")


def absent(column: str) -> Column:
    return F.coalesce(F.col(column) == "", F.lit(True))


def not_in(column: str, values: Sequence[str]) -> Column:
    return ~F.coalesce(F.col(column).isin(*values), F.lit(False))


def not_matching(column: str, pattern: str) -> Column:
    return ~F.coalesce(F.col(column).rlike(pattern), F.lit(False))


def outside(column: str, low, high) -> Column:
    return ~F.coalesce(F.col(column).between(low, high), F.lit(False))


def longer(column: str, limit: int) -> Column:
    return F.coalesce(F.length(column) > limit, F.lit(False))


def required(*columns: str) -> list[Column]:
    return [error(f"missing {c}", absent(c)) for c in columns]


def _bad_strings(column: str, optional: bool) -> Column:
    bad = F.exists(column, lambda x: F.coalesce(x == "", F.lit(True)))
    return F.coalesce(bad, F.lit(not optional))


def source_facts(sources: DataFrame) -> DataFrame:
    """Per item: number of sources, whether one is Chinese, whether all are social."""
    return sources.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_sources"), F.bool_or(F.coalesce(F.col("lang") == "zh", F.lit(False))).alias("has_zh"),
        F.bool_and(F.coalesce(F.col("tier") == "social", F.lit(False))).alias("all_social"),
    )


def item_violations(
    items: DataFrame, sources: DataFrame, settings: Settings = DEFAULT,
    topics: Sequence[str] = TOPICS, regions: Sequence[str] = REGIONS, keys: Sequence[str] = ("id",),
) -> DataFrame:
    """Rules of an item. items: text columns as written, published_at as text, window_start and
    window_end (null when the item has no window). sources: id, url, outlet, lang, tier."""
    usable = sources.filter(~not_matching("url", URL_PATTERN))
    facts = source_facts(sources).select("id", "n_sources", "all_social").join(
        source_facts(usable).select("id", "has_zh"), "id", "left"
    )
    rows = items.join(facts, "id", "left").withColumn("ts", times.parse_ts(F.col("published_at")))
    inside, graced = times.in_window(F.col("ts"), F.col("window_start"), F.col("window_end"), settings.grace_hours)
    has_window = F.col("ts").isNotNull() & F.col("window_start").isNotNull() & F.col("window_end").isNotNull()
    rules = [
        error("id is not kebab-case", not_matching("id", ID_PATTERN)),
        *required("title", "summary", "why_it_matters"),
        warning("title is long", longer("title", 140)),
        error("unknown topic", not_in("topic", topics)),
        error("unknown region", not_in("region", regions)),
        error("entities must be non-empty strings", _bad_strings("entities", optional=False)),
        error("key_numbers must be non-empty strings", _bad_strings("key_numbers", optional=True)),
        error("tickers must be non-empty strings", _bad_strings("tickers", optional=True)),
        error("no primary entity", F.coalesce(F.size("entities") < 1, F.lit(True))),
        warning("many key_numbers", F.coalesce(F.size("key_numbers") > 6, F.lit(False))),
        error("impact out of [0, 1]", outside("impact", 0.0, 1.0)),
        error("novelty out of [0, 1]", outside("novelty", 0.0, 1.0)),
        error("coverage must be positive", F.coalesce(F.col("coverage") < 1, F.lit(True))),
        error("published_at is not a zoned timestamp", F.col("ts").isNull()),
        error("published outside the window", has_window & ~graced),
        warning("published in the grace period only", has_window & graced & ~inside),
        error("no sources", F.col("n_sources").isNull()),
        warning("Chinese source without original_title", F.coalesce("has_zh", F.lit(False)) & absent("original_title")),
        warning("only social sources", F.coalesce("all_social", F.lit(False))),
    ]
    return violations(rows, keys, rules)


def source_violations(
    sources: DataFrame, domains: Mapping[str, tuple[str, str]], tiers: Sequence[str] = TIERS, langs: Sequence[str] = LANGS, keys: Sequence[str] = ("id", "pos")
) -> DataFrame:
    """Rules of a source; a known domain under another tier warns unless it is known as primary."""
    known = urls.with_known_domain(sources, "url", domains)
    bad_url = not_matching("url", URL_PATTERN)
    mismatch = F.coalesce(
        (F.col("known_tier") != F.col("tier")) & (F.col("known_tier") != "primary") & F.col("tier").isin(*tiers), F.lit(False)
    )
    rules = [
        error("url is not http(s)", bad_url),
        error("missing outlet", ~bad_url & absent("outlet")),
        error("unknown tier", ~bad_url & not_in("tier", tiers)),
        error("unknown lang", ~bad_url & not_in("lang", langs)),
        warning("tier differs from the known domain", ~bad_url & mismatch),
    ]
    return violations(known, keys, rules)


def upcoming_violations(
    events: DataFrame, keys: Sequence[str], kinds: Sequence[str] = UPCOMING_KINDS, confidence: Sequence[str] = CONFIDENCE
) -> DataFrame:
    """Rules of an upcoming event; `today` is the issue date or null."""
    day = F.col("date").try_cast("date")
    past = (F.length("date") == 10) & (day < F.date_sub("today", 1))
    rules = [
        error("date must be YYYY-MM-DD or YYYY-MM", not_matching("date", DAY_PATTERN)),
        warning("event is in the past", F.coalesce(F.col("date").rlike(DAY_PATTERN) & past, F.lit(False))),
        *required("title"),
        warning("title is long", longer("title", 110)),
        error("unknown kind", not_in("kind", kinds)),
        error("unknown confidence", not_in("confidence", confidence)),
        error("url is not http(s)", F.col("url").isNotNull() & not_matching("url", URL_PATTERN)),
    ]
    return violations(events, keys, rules)


def learn_violations(entries: DataFrame, item_ids: DataFrame, gaps: Sequence[str], max_items: int = 3) -> DataFrame:
    """Rules of learn entries: issue_date, id, rule, severity, n (times broken).

    entries: issue_date, id, gap, title, why_today, explanation, item_ids, minutes, python, refs.
    item_ids: issue_date, item_id of the issue's items."""
    keys = ["issue_date", "id"]
    lines = F.size(F.split("python", "\n"))
    rules = [
        error("id is not kebab-case", not_matching("id", ID_PATTERN)),
        error("unknown gap", not_in("gap", gaps)),
        *required("title", "why_today", "explanation"),
        warning("title is long", longer("title", 90)),
        warning("why_today is long", longer("why_today", 320)),
        warning("explanation is long", longer("explanation", 1200)),
        error("no item_ids", F.coalesce(F.size("item_ids") < 1, F.lit(True))),
        error("minutes out of [1, 120]", outside("minutes", 1, 120)),
        error("missing python", F.coalesce(F.trim("python") == "", F.lit(True))),
        warning("python is long", F.coalesce((F.trim("python") != "") & (lines > 40), F.lit(False))),
        error("ref without http(s) url", F.coalesce(F.exists("refs", lambda r: ~F.coalesce(r["url"].rlike(URL_PATTERN), F.lit(False))), F.lit(False))),
    ]
    single = violations(entries, keys, rules).groupBy(*keys, "rule", "severity").agg(F.count(F.lit(1)).alias("n"))
    twice = entries.groupBy(*keys).agg((F.count(F.lit(1)) - 1).alias("n")).filter("n > 0")
    hooks = entries.select(*keys, F.explode("item_ids").alias("item_id")).join(item_ids, ["issue_date", "item_id"], "left_anti")
    many = entries.groupBy("issue_date").agg(F.count(F.lit(1)).alias("k")).filter(F.col("k") > max_items)

    def as_errors(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.lit(name).alias("rule"), F.lit("error").alias("severity"), F.col("n").cast("bigint").alias("n"))

    return (
        single.unionByName(as_errors(twice, "duplicate id"))
        .unionByName(as_errors(hooks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "item_id is not in the issue"))
        .unionByName(as_errors(many.select("issue_date", F.lit(None).cast("string").alias("id"), F.lit(1).alias("n")), "too many entries"))
    )


def issue_violations(issues: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Rules of an issue. issues: file_date, date (text), window_start, window_end (text), tldr,
    n_items, n_sourced."""
    start, end = times.parse_ts(F.col("window_start")), times.parse_ts(F.col("window_end"))
    day = F.when(F.col("date").rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col("date").try_cast("date"))
    hours = times.hours_between(start, end)
    ok_window = start.isNotNull() & end.isNotNull()
    bad_tldr = ~F.size("tldr").between(1, 4) | F.exists("tldr", lambda t: F.coalesce(t == "", F.lit(True)))
    rules = [
        error("date must be YYYY-MM-DD", day.isNull()),
        error("date does not match the file name", F.coalesce(day != F.col("file_date"), F.lit(False))),
        error("window needs a start and an end", ~ok_window),
        error("window must start before it ends", ok_window & (hours <= 0)),
        error("window is too long", ok_window & (hours > settings.max_window_hours)),
        error("tldr must be 1-4 strings", F.coalesce(bad_tldr, F.lit(True))),
        error("no items", F.col("n_items") < 1),
        warning("few items", F.col("n_sourced").between(1, settings.leads + 2)),
    ]
    return violations(issues, ["file_date"], rules)


def weekly_violations(weeklies: DataFrame) -> DataFrame:
    """Rules of a weekly document. weeklies: file_week, week, headline, n_themes."""
    rules = [
        error("week does not match the file name", F.coalesce(F.col("week") != F.col("file_week"), F.lit(True))),
        *required("headline"),
        warning("headline is long", longer("headline", 240)),
        warning("no themes", F.coalesce(F.col("n_themes") < 1, F.lit(True))),
    ]
    return violations(weeklies, ["file_week"], rules)


def theme_violations(themes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rules of a weekly theme: title, summary."""
    return violations(themes, keys, [*required("title", "summary"), warning("title is long", longer("title", 60))])


def report(found: DataFrame, issue: str) -> DataFrame:
    """Per issue: number of errors and warnings; errors block the build."""
    return found.groupBy(issue).agg(
        F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings")
    ).withColumn("ok", F.col("errors") == 0)
