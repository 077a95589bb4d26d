"""The price store as CSV: symbol, date, close."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.market import latest_load, significant
from ..schemas import PRICES


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Closes with the later of two rows for a (symbol, date): later file path, then later in the file."""
    rows = spark.read.schema(PRICES).option("header", True).csv(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return latest_load(rows.withColumn("load_seq", place).filter("symbol is not null and date is not null"))


def write_prices(prices: DataFrame, path: str) -> None:
    """Sorted by symbol and date, closes cut to six significant digits."""
    prices.select("symbol", "date", significant(F.col("close")).alias("close")).sort("symbol", "date").write.mode(
        "overwrite"
    ).option("header", True).csv(path)
