"""From feed items to new metadata rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressroom.functions.dates import date_parts, eastern, parse_feed_date
from pressroom.schemas import METADATA, STATUS


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row of each key by ``order_by``; null keys count as equal.

    Spark ranks within each input partition before the shuffle, so a key that holds most rows
    sends at most one row per partition.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def rename_feed(items: DataFrame) -> DataFrame:
    return items.withColumnsRenamed(
        {"title": "title_text", "text": "preview_text", "sentiment": "news_api_sentiment"}
    )


def typed_feed(items: DataFrame, lenient: bool = False) -> DataFrame:
    """Scores as numbers; a score that is none fails the job unless ``lenient``."""
    score = F.col("rank_score")
    return items.withColumn(
        "rank_score", score.try_cast("double") if lenient else score.cast("double")
    )


def with_dates(items: DataFrame) -> DataFrame:
    return items.withColumn("date_utc", parse_feed_date(F.col("date")))


def drop_undated(items: DataFrame) -> DataFrame:
    return items.where(F.col("date_utc").isNotNull()).withColumns(date_parts())


def undated_count(items: DataFrame) -> DataFrame:
    return items.agg(F.count_if(F.col("date_utc").isNull()).alias("date_nulls"))


def feed_to_metadata(items: DataFrame, lenient: bool = False) -> DataFrame:
    """Metadata rows of a fetch.

    The first item of each URL is kept before dates are looked at: a first copy with a bad date
    takes later good copies with it.
    """
    items = typed_feed(rename_feed(items), lenient)
    items = keep_first(items, ["news_url"], ["ordinal"])
    return drop_undated(with_dates(items)).select(*METADATA.names, "ordinal")


def new_rows(fetched: DataFrame, stored: DataFrame, key: str = "news_id") -> DataFrame:
    """Fetched rows whose key is not stored; a null key equals a stored null."""
    seen = stored.select(F.col(key).alias("_seen"))
    return fetched.join(seen, F.col(key).eqNullSafe(F.col("_seen")), "left_anti")


def new_status(metadata: DataFrame, status: DataFrame) -> DataFrame:
    """Status rows for ids that have none yet: metadata present, all later stages open."""
    flags = {name: F.lit(name == "raw_data") for name in STATUS.names[1:]}
    return new_rows(metadata.select("news_id"), status).withColumns(flags)


def fetch_bounds(metadata: DataFrame, now: str, start_date: str | None = None) -> DataFrame:
    """One row ``start_date, end_date`` in Eastern time.

    The start is one day before the newest stored row; ``start_date`` (Eastern) serves an empty
    table. ``now`` is a UTC time given by the caller, so that a run can be repeated.
    """
    newest = eastern(F.max("date_utc") - F.expr("INTERVAL 24 HOURS"))
    fallback = F.lit(start_date).cast("timestamp")
    return metadata.agg(F.coalesce(newest, fallback).alias("start_date")).withColumn(
        "end_date", eastern(F.lit(now).cast("timestamp"))
    )
