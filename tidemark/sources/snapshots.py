"""Harvest snapshots, one partition per local harvest date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import times
from .archive import write_archive

DATE = "harvest_date"


def write_snapshot(items: DataFrame, path: str, harvested_at: Column, utc_offset_hours: int = 8) -> None:
    """Replace the snapshot of the local date of `harvested_at`; other dates stay."""
    write_archive(items.withColumn(DATE, times.local_date(harvested_at, utc_offset_hours)), path, DATE, spread="id")


def read_snapshots(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn(DATE, F.col(DATE).cast("date"))


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The newest snapshot: its date comes from the partition values, then only that one is read."""
    snapshots = read_snapshots(spark, path)
    newest = snapshots.agg(F.max(DATE)).first()[0]
    return snapshots.filter(F.col(DATE) == F.lit(newest))


def retained(snapshots: DataFrame, today: Column, keep_days: int = 30) -> DataFrame:
    """Snapshots that are not older than `keep_days`."""
    return snapshots.filter(F.date_diff(today, F.col(DATE)) <= keep_days)


def create_snapshot_table(spark: SparkSession, table: str, columns: str) -> None:
    """A catalog table of snapshots, partitioned by harvest date; columns: DDL without the date."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {DATE} DATE) USING parquet PARTITIONED BY ({DATE})")


def append_snapshot(items: DataFrame, table: str, harvested_at: Column, utc_offset_hours: int = 8) -> None:
    """Replace the partitions of the local dates of `harvested_at` in a snapshot table; other dates stay."""
    spark = items.sparkSession
    rows = items.withColumn(DATE, times.local_date(harvested_at, utc_offset_hours))
    order = [f.name for f in spark.table(table).schema]
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        rows.repartitionByRange(DATE, "id").select(*order).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(setting, before)


def prune(spark: SparkSession, table: str, today: dt.date | None = None, keep_days: int = 30) -> list[dt.date]:
    """Drop the partitions that are more than `keep_days` before `today` (the newest snapshot if not given); returns their
    dates. Only the catalog's partition list is read, no data file; the partitions that stay can be read meanwhile."""
    dates = sorted(dt.date.fromisoformat(row[0].split("=", 1)[1]) for row in spark.sql(f"SHOW PARTITIONS {table}").collect() if not row[0].endswith("__HIVE_DEFAULT_PARTITION__"))
    if not dates:
        return []
    today = today or dates[-1]
    old = [d for d in dates if (today - d).days > keep_days]
    for lo in range(0, len(old), 100):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({DATE} = DATE'{d}')" for d in old[lo : lo + 100]))
    return old
