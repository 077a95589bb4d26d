"""Result tables for readers: the dashboard mart, the feed entries, and the rebuild check.

The dashboard is a set of flat tables partitioned by month, not one document per issue, so that no
issue has to be assembled in one place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import times
from ..session import stored
from ..sources.archive import write_archive
from .views import counts_by

DEFAULT = Settings()


def dashboard_tables(
    placed: DataFrame, events: DataFrame, week: DataFrame, source_langs: DataFrame, trend: DataFrame, recap: DataFrame,
    langs: Sequence[str], settings: Settings = DEFAULT, calendar: DataFrame | None = None, lessons: DataFrame | None = None, tracker: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The dashboard's tables: `items`, `events`, `week`, `langs` and, where given, `calendar`, `learn` and `tracker` of the
    last `dashboard_days` days, the `trend`, and the recap of those of the last eight `weeks` that are closed.

    placed: issue_date, id, ... events: id and the event study. week: as_of and the rolling week.
    source_langs: item_id, lang. trend: issue_date and counts. recap: week and the weekly summary. calendar, tracker: as_of
    and more; lessons: issue_date and more. Parts of issues are kept for dates that have an issue."""
    newest = placed.agg(F.max("issue_date").alias("newest"))
    recent = placed.join(F.broadcast(newest), F.col("issue_date") > F.date_sub("newest", settings.dashboard_days)).drop("newest")
    keys = recent.select("id", "issue_date")
    lang_rows = source_langs.join(keys, source_langs["item_id"] == keys["id"])
    dates = keys.select("issue_date").distinct()
    dated = lambda df: df.withColumnRenamed("as_of", "issue_date").join(dates, "issue_date", "left_semi")
    more = {name: dated(df) for name, df in (("calendar", calendar), ("learn", lessons), ("tracker", tracker)) if df is not None}
    _, sunday = times.week_bounds(F.col("week"))
    latest = recap.orderBy(F.col("week").desc()).limit(8)
    closed = latest.withColumn("issue_date", sunday).join(F.broadcast(newest), F.col("issue_date") <= F.col("newest")).drop("newest")
    return {
        "items": recent,
        "events": events.join(keys, "id"),
        "week": dated(week),
        "langs": counts_by(lang_rows, ["issue_date"], "lang", langs),
        "trend": trend,
        "weeks": closed,
        **more,
    }


def write_dashboard(tables: dict[str, DataFrame], path: str) -> None:
    """Write the tables below `path`, partitioned by month.

    Ranging samples its rows first, so what is not merely read would be worked out twice: such tables are stored before."""
    for name, df in tables.items():
        month = (df if name == "items" else stored(df, name)).withColumn("month", F.date_format("issue_date", "yyyy-MM"))
        write_archive(month, f"{path}/{name}", "month", spread="id" if "id" in df.columns else "issue_date")


def read_dashboard(spark: SparkSession, path: str) -> DataFrame:
    """One row per issue of the mart with its counts."""
    read = lambda name: spark.read.parquet(f"{path}/{name}").drop("month")
    per_item = read("events").groupBy("id").agg(F.count(F.lit(1)).alias("k"))
    issues = read("items").join(per_item, "id", "left").groupBy("issue_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("placement") == "lead").alias("leads"),
        F.count("k").alias("stories_with_events"), F.coalesce(F.sum("k"), F.lit(0)).alias("events"),
    )
    week = read("week").select("issue_date", F.col("n").alias("week_n"), F.col("days").alias("week_days"))
    return issues.join(read("langs"), "issue_date").join(week, "issue_date")


def read_parts(spark: SparkSession, path: str, topics: Sequence[str]) -> DataFrame:
    """(part, issue_date, key, n, amount) of the mart's other tables: calendar entries per kind, lessons and tracked minutes per
    gap, topic counts of the trend (amount 1: no issue that day), items and issues of the closed weeks."""
    read = lambda name: spark.read.parquet(f"{path}/{name}")
    shape = lambda df, part, key, n, amount: df.select(F.lit(part).alias("part"), "issue_date", key.alias("key"), n.cast("bigint").alias("n"), amount.cast("bigint").alias("amount"))
    none, some = F.lit(None).cast("string"), F.col("n")
    calendar = read("calendar").groupBy("issue_date", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("date").alias("dates"))
    learn = read("learn").groupBy("issue_date", "gap").agg(F.count(F.lit(1)).alias("n"), F.sum("minutes").alias("minutes"))
    in_trend = sum((F.col(f"`{t}`") for t in topics[1:]), F.col(f"`{topics[0]}`"))
    parts = [
        shape(calendar, "calendar", F.col("kind"), some, F.col("dates")), shape(learn, "learn", F.col("gap"), some, F.col("minutes")),
        shape(read("tracker"), "tracker", F.col("gap"), some, F.col("minutes")), shape(read("trend"), "trend", none, in_trend, F.col("missing").cast("int")),
        shape(read("weeks"), "weeks", F.col("week"), some, F.col("issues")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def issue_records(items: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The items of the mart as JSON text, one row per item, for a page that embeds them."""
    return items.select("issue_date", "id", F.to_json(F.struct(*columns)).alias("record"))


def feed_entries(dailies: DataFrame, weeklies: DataFrame, limit: int = 60) -> DataFrame:
    """The newest entries: issues at the end of their window, weeks on Sunday 23:00 UTC.

    dailies: issue_date, window_end. weeklies: week."""
    day = F.date_format("issue_date", "yyyy-MM-dd")
    daily = dailies.select(
        F.concat(F.lit("daily-"), day).alias("id"), F.concat(F.lit("Daily "), day).alias("title"), F.col("window_end").alias("updated")
    )
    _, sunday = times.week_bounds(F.col("week"))
    weekly = weeklies.select(
        F.concat(F.lit("weekly-"), "week").alias("id"), F.concat(F.lit("Weekly "), "week").alias("title"),
        (sunday.cast("timestamp") + F.make_dt_interval(hours=F.lit(23))).alias("updated"),
    )
    return daily.unionByName(weekly).orderBy(F.col("updated").desc(), "id").limit(limit)


def difference(fresh: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows on one side only, with the side: what a rebuild would change."""
    return fresh.exceptAll(stored).withColumn("side", F.lit("fresh")).unionByName(
        stored.exceptAll(fresh).withColumn("side", F.lit("stored"))
    )
