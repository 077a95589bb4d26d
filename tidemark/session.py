"""Session helpers: local sessions for tests and the bench, and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: str | int = "*", app: str = "tidemark") -> SparkSession:
    """A local session for tests and benchmarks; a cluster job brings its own."""
    scratch = tempfile.mkdtemp(prefix="run-")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
        .config("spark.checkpoint.dir", os.path.join(scratch, "checkpoint"))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


#: Rows of one partition of a shuffle that `dealt` makes.
ROWS_A_PART = 250_000


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`df`, of about `rows` rows, dealt out by `keys` so that a task holds about `ROWS_A_PART` of them whatever the size of the
    table; few rows are left to the session's own shuffles. For keys that no large share of the rows has in common."""
    parts = -(-rows // ROWS_A_PART)
    return df.repartition(parts, *keys) if parts > df.sparkSession.sparkContext.defaultParallelism else df


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a table written by a job."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """`df` with `value` as column `name`, worked out once a row: a plain column is worked out again in every filter that is
    moved below it and wherever it is read from several places."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` on shared storage so that several branches, or further rounds of
    an iteration, read it instead of recomputing it. It survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: later branches read only the columns they need, and
    it outlives lost executors."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
