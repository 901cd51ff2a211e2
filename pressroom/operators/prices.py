"""Upkeep of daily price series in one long table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from pressroom import fixed_values as V
from pressroom.schemas import PRICE_BAR


def last_dates(prices: DataFrame) -> DataFrame:
    return prices.groupBy("ticker").agg(F.max("date").alias("last_date"))


def stale_tickers(prices: DataFrame, tickers: DataFrame, now: str) -> DataFrame:
    """Tickers whose newest bar is before the day of ``now``, or that have no bar."""
    today = F.to_date(F.lit(now))
    current = last_dates(prices).where(F.col("last_date") >= today).select("ticker")
    return tickers.select("ticker").distinct().join(current, "ticker", "left_anti")


def new_bars(stored: DataFrame, landed: DataFrame, now: str, full_window: bool = False) -> DataFrame:
    """Landed bars to add: after the ticker's newest stored bar, or its last two years.

    ``full_window`` takes the two years for every stale ticker, so that revised bars replace
    stored ones.
    """
    today = F.to_date(F.lit(now))
    window_start = F.date_sub(today, V.PRICE_WINDOW_DAYS)
    start = F.coalesce(F.date_add("last_date", 1), window_start)
    if full_window:
        start = window_start
    stale = F.col("last_date").isNull() | (F.col("last_date") < today)
    return (
        landed.where(F.col("date").between(window_start, today))
        .join(last_dates(stored), "ticker", "left")
        .where(stale & (F.col("date") >= start))
        .select(*PRICE_BAR.names)
    )


def keep_last_bars(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old and new bars, one per ticker and date; the new one wins."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(
        new.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    order = [F.col("_batch").desc()] + [F.col(c).desc() for c in ("volume", "close", "open", "high", "low")]
    rank = F.row_number().over(Window.partitionBy("ticker", "date").orderBy(*order))
    return both.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank", "_batch")


def refreshed_prices(
    stored: DataFrame, landed: DataFrame, now: str, full_window: bool = False
) -> DataFrame:
    """The complete series of every ticker that gets new bars; other tickers do not appear."""
    new = new_bars(stored, landed, now, full_window)
    touched = stored.join(new.select("ticker").distinct(), "ticker", "left_semi")
    return keep_last_bars(touched, new)


def wide_prices(prices: DataFrame, tickers: Sequence[str] = V.TICKERS) -> DataFrame:
    """One row per date and one column per ticker and field, named ``close_BTC-USD``."""
    fields = ["open", "high", "low", "close", "volume"]
    pivoted = (
        prices.groupBy("date")
        .pivot("ticker", list(tickers))
        .agg(*[F.first(name, ignorenulls=True).alias(name) for name in fields])
    )
    names = {f"{t}_{f}": f"{f}_{t}" for t in tickers for f in fields}
    return pivoted.withColumnsRenamed(names)


def daily_bars(ticks: DataFrame, ticker: str, stamp: str, value: str, order: str) -> DataFrame:
    """Daily bars of a tick table; ``order`` breaks ties of the time stamp."""
    at = F.struct(stamp, order)
    return ticks.groupBy(F.col(ticker).alias("ticker"), F.to_date(stamp).alias("date")).agg(
        F.min_by(value, at).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, at).alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )
