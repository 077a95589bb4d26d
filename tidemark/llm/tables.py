"""Tables of a scale-factor folder, and intermediate tables in the folder that all executors share."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from ..session import stored

__all__ = ["bounded_batches", "shielded", "stored", "table"]

#: Rows of one Arrow batch of whole texts.
BATCH_ROWS = 1000
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(df: DataFrame) -> None:
    """Make Arrow batches of this session small enough for long texts, unless the session's user has chosen a size.

    Spark's default is 10,000 rows, which of long documents is gigabytes in one batch."""
    conf = df.sparkSession.conf
    if int(conf.get(_SETTING)) == 10_000:
        conf.set(_SETTING, str(BATCH_ROWS))


def shielded(df: DataFrame, helpers: Iterable[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """`df` with columns that clash with helper names (by Spark's rule, in any case) renamed, and what gives them their names
    back. Without a clash both leave everything as it is."""
    taken, helpers = {c.lower() for c in df.columns}, {h.lower() for h in helpers}
    renamed = {}
    for c in df.columns:
        if c.lower() in helpers:
            new = f"{c}__own"
            while new.lower() in taken or new.lower() in helpers:
                new += "_"
            taken.add(new.lower())
            renamed[c] = new

    def back(out: DataFrame) -> DataFrame:
        return out.withColumnsRenamed({new: c for c, new in renamed.items()}) if renamed else out

    return (df.withColumnsRenamed(renamed) if renamed else df), back


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
