"""Daily price bars: landed files and the stored series, one partition per ticker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from pressroom import fixed_values as V
from pressroom.schemas import PRICE_BAR


def read_bars(
    spark: SparkSession,
    path: str,
    tickers: Sequence[str] = V.TICKERS,
    start: str | None = None,
    end: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Landed bars of the given tickers in ``[start, end)``."""
    reader = spark.read.schema(PRICE_BAR)
    bars = reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    bars = bars.where(F.col("ticker").isin(list(tickers)))
    if start:
        bars = bars.where(F.col("date") >= F.lit(start).cast("date"))
    if end:
        bars = bars.where(F.col("date") < F.lit(end).cast("date"))
    return bars


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """The stored series, or a typed empty frame before the first write."""
    try:
        return spark.read.schema(PRICE_BAR).parquet(path).select(*PRICE_BAR.names)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PRICE_BAR)


def ticker_series(prices: DataFrame, coin: str) -> DataFrame:
    """The series of one coin against the dollar; reads only that ticker's partition."""
    return prices.where(F.col("ticker") == f"{coin}-USD")


def write_prices(bars: DataFrame, path: str) -> None:
    """Replace the partitions of the tickers present in ``bars``; other tickers stay.

    A ticker with very many bars is split over several files by adaptive execution.
    """
    (
        bars.hint("rebalance", F.col("ticker"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ticker")
        .parquet(path)
    )
