"""Learning track: which gaps today's stories are a good hook for, and what was taught."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Gap, Settings, gap_dimension
from ..functions import scores, text
from ..session import stored
from .ranking import top_in_group

DEFAULT = Settings()


def gap_matches(items: DataFrame, body: Column, gaps: list[Gap]) -> DataFrame:
    """Items with the keywords of each gap they mention: the item's columns, gap, keywords.

    The gap list is configuration, so matching is a projection of each item and the only rows added
    are its own matches."""
    found = F.filter(
        F.array(*[F.struct(F.lit(g.id).alias("gap"), text.hits_in_marked(F.col("__body"), list(g.keywords)).alias("keywords")) for g in gaps]),
        lambda m: F.size(m["keywords"]) > 0,
    )
    return items.withColumn("__body", text.marked(body)).withColumn("__m", F.explode(found)).select("*", "__m.gap", "__m.keywords").drop("__m", "__body")


#: Leading characters of a keyword that an index entry has at most.
PREFIX = 12


def keyword_matches(items: DataFrame, key: str, body: Column, keywords: DataFrame) -> DataFrame:
    """(key, gap, keywords in their order) for a table of any number of keywords (gap, pos, keyword).

    Index and texts meet by equi-joins. A keyword of letters and digits starts a word of the text: every distinct word of the
    corpus is looked up once, by its leading characters of each length up to `PREFIX`, and one comparison confirms longer
    keywords; texts then join their words. A keyword that goes on
    after its first word needs that word as a whole, one that starts with another character needs this character at a place
    where a keyword may start; both are then searched in the marked text. `key` is unique."""
    low = F.lower("keyword")
    index = keywords.select("gap", "pos", "keyword", low.alias("low"), text.marked(F.col("keyword")).alias("sought"), F.regexp_extract(low, "^[a-z0-9]+", 0).alias("head"))
    index = stored(index.filter(F.length("low") > 0).withColumn("number", F.monotonically_increasing_id()), "keywords")
    plain = index.filter(F.col("head") == F.col("low")).withColumn("start", F.left("low", F.lit(PREFIX)))
    texts = items.select(F.col(key).alias("key"), text.marked(body).alias("marked"))
    words = stored(
        texts.select("key", F.explode(F.array_distinct(F.regexp_extract_all("marked", F.lit(f"{text.MARK}([a-z0-9]+)"), F.lit(1)))).alias("word")), "words"
    )
    lengths = F.sequence(F.lit(1), F.least(F.length("word"), F.lit(PREFIX)))
    starts = words.select("word").distinct().select("word", F.explode(F.transform(lengths, lambda n: F.left("word", n))).alias("start"))
    known = starts.join(plain, "start").filter(F.startswith("word", "low")).groupBy("word").agg(F.collect_set("number").alias("numbers"))
    by_word = words.join(known, "word").select("key", "numbers")

    longer = index.filter((F.col("head") != F.col("low")) & (F.col("head") != ""))
    other = index.filter(F.col("head") == "").withColumn("head", F.left("low", F.lit(1)))
    marks = texts.select("key", F.explode(F.array_distinct(F.regexp_extract_all("marked", F.lit(f"(?s){text.MARK}([^a-z0-9])"), F.lit(1)))).alias("word"))
    likely = words.join(longer, words["word"] == longer["head"]).unionByName(marks.join(other, marks["word"] == other["head"]))
    searched = likely.select("key", "number", "sought").join(texts, "key").filter(F.contains("marked", "sought"))

    # Texts and keywords meet as numbers, one list a word; the keywords themselves come in when a text's lists are one.
    found = by_word.unionByName(searched.select("key", F.array("number").alias("numbers"))).repartition("key").groupBy("key")
    once = found.agg(F.array_distinct(F.flatten(F.collect_list("numbers"))).alias("numbers")).select("key", F.explode("numbers").alias("number"))
    listed = once.join(index.select("number", "gap", "pos", "keyword"), "number").groupBy("key", "gap").agg(F.array_sort(F.collect_list(F.struct("pos", "keyword"))).alias("hits"))
    return listed.select(F.col("key").alias(key), "gap", F.transform("hits", lambda h: h["keyword"]).alias("keywords"))


def hook_weight(total: Column, impact: Column) -> Column:
    return F.coalesce(total / F.lit(100.0), impact, F.lit(0.0))


def last_taught(taught: DataFrame, dates: DataFrame, gaps: list[Gap]) -> DataFrame:
    """(issue_date, gap, last_taught): the latest earlier date with a lesson on the gap.

    taught: issue_date, gap. One row per gap and date, so the window is bounded by the calendar."""
    marked = taught.select("issue_date", "gap").distinct().withColumn("taught_on", F.col("issue_date"))
    earlier = Window.partitionBy("gap").orderBy("issue_date").rowsBetween(Window.unboundedPreceding, -1)
    every_gap = F.explode(F.array(*[F.lit(g.id) for g in gaps]))
    spine = dates.select("issue_date").distinct().select("issue_date", every_gap.alias("gap"))
    return spine.join(marked, ["issue_date", "gap"], "left").select(
        "issue_date", "gap", F.max("taught_on").over(earlier).alias("last_taught")
    )


def rank_gaps(matches: DataFrame, dates: DataFrame, taught: DataFrame, gaps: list[Gap], settings: Settings = DEFAULT) -> DataFrame:
    """Score of every gap for every date: priority x (1 + hook) x damping, with its position.

    matches: issue_date, id, gap, weight."""
    dim = gap_dimension(dates.sparkSession, gaps)
    hooks = matches.groupBy("issue_date", "gap").agg(F.sum("weight").alias("h"), F.count(F.lit(1)).alias("n_hooks"))
    since = F.date_diff("issue_date", "last_taught")
    rows = (
        last_taught(taught, dates, gaps)
        .join(hooks, ["issue_date", "gap"], "left")
        .join(F.broadcast(dim), "gap")
        .withColumn("p", scores.gap_priority(F.col("now"), F.col("target"), F.col("weight")))
        .withColumn("hk", scores.hook(F.coalesce("h", F.lit(0.0))))
        .withColumn("dp", scores.damping(since, settings.recency_tau_days))
        .select(
            "issue_date", "gap", "label", since.alias("days_since"), F.coalesce("n_hooks", F.lit(0)).alias("n_hooks"),
            F.round("p", 3).alias("priority"), F.round("hk", 3).alias("hook"), F.round("dp", 3).alias("damp"),
            F.round(F.col("p") * (1 + F.col("hk")) * F.col("dp"), 3).alias("score"),
        )
    )
    order = Window.partitionBy("issue_date").orderBy(F.col("score").desc(), F.col("priority").desc(), F.col("gap").asc())
    return rows.withColumn("position", F.row_number().over(order).cast("bigint"))


def hook_stories(matches: DataFrame, k: int = 3) -> DataFrame:
    """The heaviest matching stories of each date and gap."""
    return top_in_group(matches, ["issue_date", "gap"], [F.col("weight").desc(), F.col("id").asc()], k)


def tracker(taught: DataFrame, gaps: list[Gap], as_of: Column, settings: Settings = DEFAULT) -> DataFrame:
    """Per gap: lessons, minutes and last date of the last `tracker_days` days; gaps without any stay.

    taught: issue_date, gap, minutes."""
    dim = gap_dimension(taught.sparkSession, gaps)
    recent = taught.filter(F.col("issue_date").between(F.date_sub(as_of, settings.tracker_days - 1), as_of))
    sums = recent.groupBy("gap").agg(
        F.count(F.lit(1)).alias("n"), F.sum("minutes").alias("minutes"), F.max("issue_date").alias("last")
    )
    return dim.join(sums, "gap", "left").select(
        "gap", "label", "short", "now", "target",
        F.round(scores.gap_priority(F.col("now"), F.col("target"), F.col("weight")), 3).alias("priority"),
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("minutes", F.lit(0)).alias("minutes"), "last",
    ).orderBy(F.col("priority").desc(), "gap")


def tracker_days(taught: DataFrame, gaps: list[Gap], days: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """The tracker of many days at once: as_of, gap, n, minutes, last; gaps without lessons stay. days: distinct as_of.

    Lessons are added up per gap and date before they are repeated for the days that can see them."""
    daily = taught.groupBy("gap", "issue_date").agg(F.count(F.lit(1)).alias("n"), F.sum("minutes").alias("minutes"))
    seen = daily.withColumn("as_of", F.explode(F.sequence("issue_date", F.date_add("issue_date", settings.tracker_days - 1)))).join(days, "as_of", "left_semi")
    sums = seen.groupBy("as_of", "gap").agg(F.sum("n").alias("n"), F.sum("minutes").alias("minutes"), F.max("issue_date").alias("last"))
    spine = days.select("as_of", F.explode(F.array(*[F.lit(g.id) for g in gaps])).alias("gap"))
    return spine.join(sums, ["as_of", "gap"], "left").select(
        "as_of", "gap", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("minutes", F.lit(0)).alias("minutes"), "last"
    )


def streaks(lessons: DataFrame) -> DataFrame:
    """(issue_date, streak): archived issues in a row, up to each one, that have a lesson.

    lessons: issue_date, n_lessons, one row per archived issue; the windows are over the calendar only."""
    by_day = Window.orderBy("issue_date")
    breaks = F.count_if(F.col("n_lessons") == 0).over(by_day)
    rows = lessons.withColumn("island", breaks)
    inside = Window.partitionBy("island").orderBy("issue_date")
    return rows.withColumn("streak", F.count_if(F.col("n_lessons") > 0).over(inside)).select("issue_date", "streak")
