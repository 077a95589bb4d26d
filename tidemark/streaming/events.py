"""Streaming twins of the time-window operators.

Every query is a Structured Streaming job that ends when its input is used up (`availableNow`), with its
checkpoint on the shared folder. Aggregates leave the stream in update mode: each micro-batch appends
the windows it changed together with the batch id, and `latest` reads the last state of each window, so
nothing is held in a driver-side sink and a repeated batch does no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import scores
from ..session import work_path

DEFAULT = Settings()


def read_events(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """A folder of Parquet files as a stream, oldest file first."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def accepted(published: Column, arrived: Column, settings: Settings = DEFAULT) -> Column:
    """Published at most `since_hours` before it arrived, and not more than an hour ahead. A watermark
    drops nothing in a stateless query, so the bound is an explicit filter."""
    since = arrived - F.make_dt_interval(hours=F.lit(settings.since_hours))
    return published.between(since, arrived + F.make_dt_interval(hours=F.lit(1)))


def first_arrivals(events: DataFrame, time: str, key: str, days: int = 7) -> DataFrame:
    """Drop later arrivals of a key within the watermark. The first arrival stays, not the earliest
    publication (the batch merge keeps that one)."""
    return events.withWatermark(time, f"{days} days").dropDuplicatesWithinWatermark([key])


def day_counts(events: DataFrame, time: str, keys: list[str], lateness_hours: int = 36) -> DataFrame:
    """Events per day and key."""
    day = F.window(time, "1 day")
    counts = events.withWatermark(time, f"{lateness_hours} hours").groupBy(day, *keys).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.to_date("window.start").alias("day"), *keys, "n")


def sliding_counts(events: DataFrame, time: str, key: str, settings: Settings = DEFAULT, lateness_hours: int = 36) -> DataFrame:
    """Events per key in the `baseline_days` before each day: the window that ends at the day's start."""
    days = F.window(time, f"{settings.baseline_days} days", "1 day")
    counts = events.withWatermark(time, f"{lateness_hours} hours").groupBy(days, key).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(F.to_date("window.end").alias("day"), key, "n")


def trailing_days(events: DataFrame, time: str, settings: Settings = DEFAULT, lateness_hours: int = 36) -> DataFrame:
    """(day, days_seen): days with any event among the `baseline_days` before each day, from the stream alone.

    Two chained aggregations in append mode: the days of the stream, each once it is closed, then windows over days."""
    days = events.withWatermark(time, f"{lateness_hours} hours").groupBy(F.window(time, "1 day")).agg(F.count(F.lit(1)).alias("events"))
    windows = F.window(F.window_time("window"), f"{settings.baseline_days} days", "1 day")
    return days.groupBy(windows).agg(F.count(F.lit(1)).alias("days_seen")).select(F.to_date("window.end").alias("day"), "days_seen")


def trailing_counts(events: DataFrame, time: str, key: str, settings: Settings = DEFAULT, lateness_hours: int = 36) -> DataFrame:
    """(day, key, n): events per key in the `baseline_days` before each day, from daily counts; append mode."""
    daily = events.withWatermark(time, f"{lateness_hours} hours").groupBy(F.window(time, "1 day"), key).agg(F.count(F.lit(1)).alias("n"))
    windows = F.window(F.window_time("window"), f"{settings.baseline_days} days", "1 day")
    return daily.groupBy(windows, key).agg(F.sum("n").alias("n")).select(F.to_date("window.end").alias("day"), key, "n")


def run_append(stream: DataFrame, spark: SparkSession, name: str, path: str | None = None) -> str:
    """Run a stream that only appends rows into a Parquet folder; returns the folder. With the `path` of an earlier run it
    goes on from that run's checkpoint."""
    path = path or work_path(spark, name)
    query = (
        stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/checkpoint")
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return f"{path}/rows"


def run_update(stream: DataFrame, spark: SparkSession, name: str) -> str:
    """Run an aggregation in update mode; changed rows are written per batch; returns the folder."""
    path = work_path(spark, name)

    def save(batch: DataFrame, batch_id: int) -> None:
        # A batch that is run again after a failure replaces its own folder.
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    query = (
        stream.writeStream.foreachBatch(save).option("checkpointLocation", f"{path}/checkpoint")
        .outputMode("update").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return f"{path}/rows"


def latest(spark: SparkSession, path: str, keys: list[str], value: str = "n") -> DataFrame:
    """The last state of every key in a folder written by `run_update`."""
    return spark.read.parquet(path).groupBy(*keys).agg(F.max_by(value, "batch").alias(value))


def baseline(window_counts: DataFrame, days: DataFrame, settings: Settings = DEFAULT) -> DataFrame:
    """(day, key, baseline): window counts over the days seen in the window.

    window_counts: day, key, n as of `sliding_counts`. days: distinct days with any event."""
    later = F.sequence(F.date_add("day", 1), F.date_add("day", settings.baseline_days))
    seen = days.select(F.explode(later).alias("day")).groupBy("day").agg(F.count(F.lit(1)).alias("days_seen"))
    return window_counts.join(seen, "day").withColumn("baseline", F.col("n") / F.col("days_seen")).drop("n", "days_seen")


def baseline_from_stream(window_counts: DataFrame, days_seen: DataFrame) -> DataFrame:
    """(day, key, baseline) from `trailing_counts` and `trailing_days`."""
    return window_counts.join(days_seen, "day").withColumn("baseline", F.col("n") / F.col("days_seen")).drop("n", "days_seen")


def burst(counts: DataFrame, base: DataFrame, key: str) -> DataFrame:
    """Momentum of each key on each day against its own baseline."""
    return counts.join(base, ["day", key], "left").withColumn(
        "momentum", scores.momentum(F.col("n"), F.coalesce("baseline", F.lit(0.0)))
    )
