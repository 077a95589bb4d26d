"""The archive of issues: JSON documents as they are written, and Parquet by date for everything else."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times
from ..schemas import DAILY, WEEKLY

# --- fixed values: file names of daily and weekly documents -------------------------------
DAILY_NAME = r"^(\d{4}-\d{2}-\d{2})\.json$"
WEEKLY_NAME = r"^(\d{4}-W\d{2})\.json$"


def _documents(spark: SparkSession, path: str, schema: str, pattern: str) -> DataFrame:
    named = F.regexp_extract(F.col("_metadata.file_name"), pattern, 1)
    docs = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("__name", named)
    return docs.filter(F.col("__name") != "")


def read_daily(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Daily documents with `issue_date` from the file name; other files in the folder are ignored."""
    docs = _documents(spark, path, DAILY, DAILY_NAME).withColumn("issue_date", F.col("__name").try_cast("date")).drop("__name")
    return between(docs.filter("issue_date is not null"), "issue_date", start, end)


def read_weekly(spark: SparkSession, path: str) -> DataFrame:
    """Weekly documents with `file_week` from the file name."""
    return _documents(spark, path, WEEKLY, WEEKLY_NAME).withColumnRenamed("__name", "file_week")


def between(df: DataFrame, column: str, start: str | None, end: str | None) -> DataFrame:
    if start:
        df = df.filter(F.col(column) >= F.lit(start).cast("date"))
    if end:
        df = df.filter(F.col(column) <= F.lit(end).cast("date"))
    return df


def write_archive(df: DataFrame, path: str, by: str, fmt: str = "parquet", spread: str | None = None) -> None:
    """Write partitioned by a date or week column; only the partitions present in `df` are replaced.

    With `spread`, a column that varies within a partition, rows are ranged by (by, spread) first: few
    files per partition, and a very large partition is still written by several tasks."""
    if spread:
        df = df.repartitionByRange(by, spread)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).format(fmt).save(path)


def read_archive(spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet", by: str | None = None,
                 start: str | None = None, end: str | None = None) -> DataFrame:
    """Read back; a range on the partition column prunes partitions before any file is opened."""
    reader = spark.read.format(fmt)
    df = (reader.schema(schema) if schema else reader).load(path)
    return between(df, by, start, end) if by else df


def issue_items(daily: DataFrame) -> DataFrame:
    """One row per item of daily documents, with its place in the document."""
    return daily.select("issue_date", F.posexplode("items").alias("item_pos", "i")).select("issue_date", "item_pos", "i.*")


def item_sources(items: DataFrame, *keys: str) -> DataFrame:
    """One row per source of an item, with its place."""
    return items.select(*keys, F.posexplode("sources").alias("pos", "s")).select(*keys, "pos", "s.*")


def upcoming_of(docs: DataFrame, seen_on: Column) -> DataFrame:
    """Upcoming events with the date they were announced on."""
    return docs.select(seen_on.alias("seen_on"), F.posexplode("upcoming").alias("pos", "e")).select("seen_on", "pos", "e.*")


def learn_of(daily: DataFrame) -> DataFrame:
    return daily.select("issue_date", F.explode("learn").alias("l")).select("issue_date", "l.*")


def weekly_items(weekly: DataFrame) -> DataFrame:
    """Back-fill items of weekly documents."""
    return weekly.select(F.col("file_week").alias("week"), F.explode("items").alias("i")).select("week", "i.*")


def items_between(daily: DataFrame, weekly: DataFrame, start: Column, end: Column, utc_offset_hours: int = 8) -> DataFrame:
    """Items of daily issues in [start, end], and weekly back-fill items published there (reader's
    date) whose id no daily item of the range has.

    daily: issue_date, id, ... weekly: week, id, published_at, ..., same other columns."""
    in_range = daily.filter(F.col("issue_date").between(start, end))
    monday, sunday = times.week_bounds(F.col("week"))
    filled = (
        weekly.filter((sunday >= start) & (monday <= end))
        .withColumn("issue_date", times.local_date(F.col("published_at"), utc_offset_hours))
        .filter(F.col("issue_date").between(start, end))
        .join(in_range.select("id").distinct(), "id", "left_anti")
        .drop("week")
    )
    return in_range.unionByName(filled, allowMissingColumns=True)
