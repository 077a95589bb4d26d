"""Rolling week, ISO-week recap, trend and leaderboards, for all dates or weeks of the archive at once.

Everything is counted per date first; the date-level tables are then spread over the windows they
belong to, so no window ever re-reads items.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import times
from .placement import rank_order
from .ranking import top_in_group

DEFAULT = Settings()


def counts_by(df: DataFrame, group: Sequence[str], column: str, values: Sequence[str]) -> DataFrame:
    """One column per value of a vocabulary, zero-filled, in vocabulary order. One hash aggregation: a pivot would first keep a
    row for each value and then an object for each group."""
    return df.groupBy(*group).agg(*[F.count_if(F.col(column) == F.lit(v)).alias(str(v)) for v in values])


def entity_weights(scored: DataFrame, item_entities: DataFrame, group: Sequence[str], settings: Settings = DEFAULT) -> DataFrame:
    """(group, entity, weight, mentions): the primary entity gets the item's total, any other a share.
    Totals have one decimal, so the sums are exact decimals and do not depend on their order.

    item_entities: id, entity, pos (0 = primary), each entity once per item; names keep their case."""
    share = F.when(F.col("pos") == 0, F.lit("1").cast("decimal(4,3)")).otherwise(F.lit(settings.secondary_weight).cast("decimal(4,3)"))
    return (
        item_entities.select("id", "entity", "pos").join(scored.select("id", *group, "total"), "id")
        .groupBy(*group, "entity")
        .agg(F.sum(F.col("total").cast("decimal(6,1)") * share).alias("weight"), F.count(F.lit(1)).alias("mentions"))
    )


def entity_board(weights: DataFrame, group: Sequence[str], k: int = 8) -> DataFrame:
    order = [F.col("weight").desc(), F.col("mentions").desc(), F.col("entity").asc()]
    return top_in_group(weights, group, order, k).withColumn("weight", F.round(F.col("weight"), 1).cast("double"))


def spread(df: DataFrame, day: str, days: int, dates: DataFrame) -> DataFrame:
    """Repeat each row of a date-level table for every archived date `as_of` whose last `days` days
    include it. `dates` has distinct `as_of`."""
    later = F.explode(F.sequence(F.col(day), F.date_add(day, days - 1)))
    return df.withColumn("as_of", later).join(dates, "as_of", "left_semi")


def open_per_day(ranges: DataFrame, first: str, last: str) -> DataFrame:
    """(day, n): how many ranges [first, last] hold each day, both ends included; days without any are left out.

    A range is a start on its first day and an end after its last, counted per day; n is the sum of starts less ends so far over
    the days of the calendar, so the rows are the days and not the days of every range or pair of dates."""
    held = ranges.filter(F.col(first) <= F.col(last))
    ends = F.explode(F.array(
        F.struct(F.col(first).alias("day"), F.lit(1).alias("step")), F.struct(F.date_add(last, 1).alias("day"), F.lit(-1).alias("step"))
    ))
    steps = held.select(ends.alias("e")).groupBy("e.day").agg(F.sum("e.step").alias("step"))
    days = steps.agg(F.min("day").alias("a"), F.max("day").alias("z")).select(F.explode(times.days_between(F.col("a"), F.col("z"))).alias("day"))
    n = F.sum(F.coalesce("step", F.lit(0))).over(Window.orderBy("day"))  # one row a day of the calendar
    return days.join(steps, "day", "left").select("day", n.alias("n")).filter("n > 0")


def rolling_summary(items: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Per archived date (as_of) of the seven days that end on it: days, n and a count per topic. items: issue_date, topic;
    neither scores nor places are needed."""
    per_day = counts_by(items, ["issue_date"], "topic", topics)
    dates = per_day.select(F.col("issue_date").alias("as_of"))
    n = sum((F.col(f"`{t}`") for t in topics[1:]), F.col(f"`{topics[0]}`"))
    return (
        spread(per_day.withColumn("n", n), "issue_date", 7, dates)
        .groupBy("as_of")
        .agg(F.count(F.lit(1)).alias("days"), F.sum("n").alias("n"), *[F.sum(f"`{t}`").alias(t) for t in topics])
    )


def rolling_entities(scored: DataFrame, item_entities: DataFrame, settings: Settings = DEFAULT, k: int = 6) -> DataFrame:
    """The `k` first entities of the seven days that end on each archived date."""
    dates = scored.select(F.col("issue_date").alias("as_of")).distinct()
    weights = entity_weights(scored, item_entities, ["issue_date"], settings)
    week_weights = (
        spread(weights, "issue_date", 7, dates).groupBy("as_of", "entity")
        .agg(F.sum("weight").alias("weight"), F.sum("mentions").alias("mentions"))
    )
    return entity_board(week_weights, ["as_of"], k)


def rolling_top(scored: DataFrame, leads: DataFrame, settings: Settings = DEFAULT, k: int = 5) -> DataFrame:
    """The best stories of the seven days that end on each archived date and do not lead on it. leads: issue_date, id."""
    dates = scored.select(F.col("issue_date").alias("as_of")).distinct()
    # k others can only come from the first k of a past day, or from today's first k after its leads.
    rows = scored.select("issue_date", "id", "total", "credibility")
    best = top_in_group(rows, ["issue_date"], rank_order(), settings.leads + k, "day_rn")
    marked = best.join(leads.select("issue_date", "id", F.lit(True).alias("is_lead")), ["issue_date", "id"], "left")
    others = spread(marked, "issue_date", 7, dates).filter((F.col("issue_date") < F.col("as_of")) | F.col("is_lead").isNull())
    return top_in_group(others, ["as_of"], rank_order(), k)


def rolling_week(
    placed: DataFrame, item_entities: DataFrame, topics: Sequence[str], settings: Settings = DEFAULT
) -> dict[str, DataFrame]:
    """The seven days ending on each archived date: `summary` (days, n, topics), `entities`, `top`
    (best stories that do not lead today). placed: scored items with issue_date and placement."""
    return {
        "summary": rolling_summary(placed, topics),
        "entities": rolling_entities(placed, item_entities, settings),
        "top": rolling_top(placed, placed.filter("placement = 'lead'"), settings),
    }


def trend(items: DataFrame, archived: DataFrame, end: Column, days: int, topics: Sequence[str]) -> DataFrame:
    """Topic counts per day of [end - days + 1, end], from the first archived day on; days without an
    issue stay, marked `missing`. archived: distinct issue_date."""
    bounds = archived.agg(F.min("issue_date").alias("first_day"))
    start = F.greatest(F.date_sub(end, days - 1), F.col("first_day"))
    spine = bounds.select(F.explode(times.days_between(start, end)).alias("issue_date"))
    counts = counts_by(items, ["issue_date"], "topic", topics)
    return (
        spine.join(archived.withColumn("have", F.lit(True)), "issue_date", "left")
        .join(counts, "issue_date", "left")
        .na.fill(0, list(topics))
        .withColumn("missing", F.col("have").isNull())
        .drop("have")
    )


def weekly_recap(
    scored: DataFrame, item_entities: DataFrame, sources: DataFrame, topics: Sequence[str], langs: Sequence[str], settings: Settings = DEFAULT
) -> dict[str, DataFrame]:
    """Per ISO week: `summary` (n, issues, topics), `langs`, `per_day`, `entities`, `top`."""
    weekly = scored.withColumn("week", times.week_id(F.col("issue_date")))
    per_day = counts_by(weekly, ["week", "issue_date"], "topic", topics)
    n = sum((F.col(f"`{t}`") for t in topics[1:]), F.col(f"`{topics[0]}`"))
    summary = per_day.withColumn("n", n).groupBy("week").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("issues"), *[F.sum(f"`{t}`").alias(t) for t in topics]
    )
    by_lang = sources.groupBy("item_id", "lang").agg(F.count(F.lit(1)).alias("k"))
    lang_rows = by_lang.join(weekly.select(F.col("id").alias("item_id"), "week"), "item_id")
    lang_counts = lang_rows.groupBy("week").pivot("lang", list(langs)).sum("k").na.fill(0, list(langs))
    weights = entity_weights(weekly, item_entities, ["week"], settings)
    return {
        "summary": summary,
        "langs": lang_counts,
        "per_day": week_matrix(per_day, topics),
        "entities": entity_board(weights, ["week"], 8),
        "top": top_in_group(weekly.select("week", "issue_date", "id", "total", "credibility"), ["week"], rank_order(), 10),
    }


def week_matrix(per_day: DataFrame, topics: Sequence[str]) -> DataFrame:
    """All seven days of every week with their topic counts; `issue` tells whether there was one."""
    monday, sunday = times.week_bounds(F.col("week"))
    spine = per_day.select("week").distinct().select("week", F.explode(F.sequence(monday, sunday)).alias("issue_date"))
    have = per_day.withColumn("issue", F.lit(True))
    return spine.join(have, ["week", "issue_date"], "left").na.fill(0, list(topics)).na.fill(False, ["issue"])


def topic_matrix_rollup(scored: DataFrame) -> DataFrame:
    """Week x topic x day counts with their totals (null = all)."""
    return scored.withColumn("week", times.week_id(F.col("issue_date"))).rollup("week", "topic", "issue_date").agg(
        F.count(F.lit(1)).alias("n")
    )


def theme_items(weeklies: DataFrame) -> DataFrame:
    """(week, theme, pos, id) of the themes of weekly documents, ids in their order."""
    themes = weeklies.select("week", F.explode("themes").alias("t"))
    return themes.select("week", F.col("t.title").alias("theme"), F.posexplode("t.item_ids").alias("pos", "id"))


def theme_refs(listed: DataFrame, refs: DataFrame) -> DataFrame:
    """Theme items with the item's columns, `pos` giving their order; unresolved ids are skipped.

    listed: week, theme, pos, id. refs: week, id and the columns to show."""
    return listed.join(refs, ["week", "id"])


def unresolved_refs(listed: DataFrame, refs: DataFrame) -> DataFrame:
    """Theme ids that are not items of the theme's week."""
    return listed.join(refs.select("week", "id"), ["week", "id"], "left_anti")


def issue_summary(placed: DataFrame, topics: Sequence[str]) -> DataFrame:
    """Per issue: n, leads, best total and the counts of its topics."""
    facts = placed.groupBy("issue_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("placement") == "lead").alias("leads"), F.max("total").alias("top_score")
    )
    return facts.join(counts_by(placed, ["issue_date"], "topic", topics), "issue_date")


def shares(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of each count column in their sum; null when the sum is 0."""
    total = F.nullif(sum((F.col(f"`{c}`") for c in columns[1:]), F.col(f"`{columns[0]}`")), F.lit(0))
    return counts.withColumns({f"{c}_share": F.col(f"`{c}`") / total for c in columns})


def item_refs(items: DataFrame, first_source: DataFrame) -> DataFrame:
    """Compact pointers: date, id, topic, region, score and the display source."""
    return items.select("issue_date", "id", "topic", "region", F.col("total").alias("score")).join(first_source, "id")


def display_source(sources: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first source of every item in document order."""
    return sources.groupBy("item_id").agg(F.min_by(F.struct("url", "outlet"), F.struct(*order)).alias("s")).select(
        F.col("item_id").alias("id"), "s.url", "s.outlet"
    )


def issue_windows(issues: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """Collection window of every run: from the end of the previous issue, at most `max_window_hours`
    back (then `gap`), or 24 hours for the first; dated by the local date of the midpoint.

    issues: issue_date, window_end, one row per issue date. The previous end is that of the latest-dated
    earlier issue. Rows are at most one per date, so the ordering window is over the calendar only."""
    prev = F.lag("window_end").over(Window.orderBy("issue_date"))
    rows = issues.withColumn("window_end", F.date_trunc("minute", "window_end")).withColumn("previous_end", prev)
    return close_window(rows, settings)


def close_window(rows: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """window_start, gap, hours, local issue day, week and whether it closes the week, from
    `window_end` and `previous_end`."""
    hours = times.hours_between(F.col("previous_end"), F.col("window_end"))
    cap = F.make_dt_interval(hours=F.lit(settings.max_window_hours))
    day = F.make_dt_interval(hours=F.lit(24))
    start = (
        F.when(F.col("previous_end").isNull(), F.col("window_end") - day)
        .when(hours > settings.max_window_hours, F.col("window_end") - cap)
        .otherwise(F.col("previous_end"))
    )
    half = (F.unix_seconds("window_end") - F.unix_seconds("window_start")) / 2
    midpoint = F.timestamp_seconds(F.unix_seconds("window_start") + half)
    return (
        rows.withColumn("window_start", start)
        .withColumn("gap", F.coalesce(hours > settings.max_window_hours, F.lit(False)))
        .withColumn("hours", times.hours_between(F.col("window_start"), F.col("window_end")))
        .withColumn("local_day", times.local_date(midpoint, settings.utc_offset_hours))
        .withColumn("week", times.week_id(F.col("local_day")))
        .withColumn("closes_week", F.extract(F.lit("DAYOFWEEK_ISO"), F.col("local_day")) == 7)
    )


def next_window(issues: DataFrame, now: Column, settings: Settings = DEFAULT) -> DataFrame:
    """The window of a run at `now`: one row."""
    end = F.date_trunc("minute", now)
    prev = F.max_by("window_end", F.when(F.col("window_end") < end, F.col("issue_date")))
    return close_window(issues.agg(prev.alias("previous_end")).withColumn("window_end", end), settings)
