"""Bursts with state per entity: each key keeps the counts of its last days.

A key's state is one value, the counts of the days that a baseline can still need. An event-time timer is set for the end of
a key's first open day; it fires when the watermark has passed it, so late rows within the watermark are counted. It puts out
the counts of all days that the watermark has passed, each with the sum of the `baseline_days` before it, forgets what no
later day can need, and is set again if days are left open. So a key costs one timer a batch, however many days close. State
is small: at most `baseline_days` closed days and the open ones. It needs Spark's RocksDB state store (`state_store`).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..config import Settings
from ..functions import scores

DEFAULT = Settings()
DAY_MS = 86_400_000


def state_store(spark: SparkSession) -> None:
    """Use the state store that keeps timers; for a session of the stream's own."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class DayBursts(StatefulProcessor):
    """Counts of each key's days; days are put out when the key's timer fires. Days before `upto` are out."""

    def __init__(self, days: int):
        self.days = days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("counts", "days array<int>, counts array<bigint>, upto int")

    def _counts(self) -> tuple[dict[int, int], int]:
        found = self.state.get()
        return (dict(zip(found[0], found[1], strict=True)), found[2]) if found else ({}, -(1 << 31))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        counts, upto = self._counts()
        due = min((d for d in counts if d >= upto), default=None)
        for row in rows:
            counts[row["day"]] = counts.get(row["day"], 0) + row["n"]
        first = min((d for d in counts if d >= upto), default=None)
        if first != due:
            self.handle.registerTimer((first + 1) * DAY_MS)
        self.state.update((list(counts), list(counts.values()), upto))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        counts, upto = self._counts()
        passed = timerValues.getCurrentWatermarkInMs() // DAY_MS
        closed = sorted(d for d in counts if upto <= d < passed)
        if not closed:  # a timer of a later day that has been put out with an earlier one
            return
        for day in closed:
            before = sum(counts.get(d, 0) for d in range(day - self.days, day))
            yield Row(key=key[0], day=day, n=counts[day], before=before)
        upto, left = closed[-1] + 1, [d for d in counts if d > closed[-1]]
        if left:
            self.handle.registerTimer((min(left) + 1) * DAY_MS)
        # The next day to close is not before the watermark's own.
        counts = {d: n for d, n in counts.items() if d >= passed - self.days}
        if counts:
            self.state.update((list(counts), list(counts.values()), upto))
        else:
            self.state.clear()

    def close(self) -> None:
        pass


def day_bursts(events: DataFrame, time: str, key: str, settings: Settings = DEFAULT, lateness_hours: int = 36) -> DataFrame:
    """(day, key, n, before) for every day of a key, when the day is closed; append mode. before: the key's events in the
    `baseline_days` before."""
    kind = events.schema[key].dataType.simpleString()
    # One condition that reads the time as well: Spark moves others below the watermark, which rows without a key then miss.
    known = F.when(F.col(time).isNotNull(), F.col(key).isNotNull()).otherwise(F.lit(False))
    rows = events.withWatermark(time, f"{lateness_hours} hours").filter(known)
    days = F.floor(F.unix_millis(time) / DAY_MS).cast("int")
    found = rows.select(F.col(key).alias("key"), time, days.alias("day"), F.lit(1).cast("bigint").alias("n")).groupBy("key").transformWithState(
        statefulProcessor=DayBursts(settings.baseline_days), outputStructType=f"key {kind}, day int, n bigint, before bigint", outputMode="Append", timeMode="EventTime"
    )
    return found.select(F.date_from_unix_date("day").alias("day"), F.col("key").alias(key), "n", "before")


def momentum_of(days: DataFrame, days_seen: DataFrame) -> DataFrame:
    """Rows of `day_bursts` with the momentum against the baseline; days_seen: day, days_seen."""
    share = F.coalesce(F.try_divide("before", "days_seen"), F.lit(0.0))
    return days.join(days_seen, "day", "left").withColumn("momentum", scores.momentum(F.col("n"), share)).drop("days_seen")
