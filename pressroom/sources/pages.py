"""Fetched pages: HTML landed by a fetcher outside this library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressroom.schemas import FETCHED_PAGE


def read_fetched_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FETCHED_PAGE).parquet(path)


def as_fetched(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """A plain (url, html) table as successful fetches."""
    return pages.select(
        F.col(url).alias("news_url"),
        F.col(html).alias("html"),
        F.lit(200).alias("status_code"),
        F.lit(None).cast("string").alias("error_kind"),
        F.lit(None).cast("string").alias("error"),
        F.lit(0.0).alias("elapsed_time"),
    )
