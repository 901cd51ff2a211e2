"""The price job: all tickers in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressroom.operators.prices import refreshed_prices
from pressroom.schemas import PRICE_BAR
from pressroom.session import work_dir
from pressroom.sources.prices import read_prices, write_prices


def store_prices(
    spark: SparkSession, path: str, landed: DataFrame, now: str, full_window: bool = False
) -> None:
    """Add landed bars to the stored series and rewrite the tickers that changed.

    The new series are written aside first: a partition must not be replaced while it is read.
    """
    aside = work_dir(spark, "prices")
    refreshed_prices(read_prices(spark, path), landed, now, full_window).write.parquet(aside)
    refreshed = spark.read.schema(PRICE_BAR).parquet(aside)
    if not refreshed.isEmpty():
        write_prices(refreshed, path)
