"""The work-state table: what each stage still has to do, and marking it done."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def pending(status: DataFrame, done: list[str], open_stage: str) -> DataFrame:
    """Rows with every stage of ``done`` finished and ``open_stage`` not."""
    condition = ~F.col(open_stage)
    for stage in done:
        condition = condition & F.col(stage)
    return status.where(condition)


def pending_scrape(status: DataFrame) -> DataFrame:
    return pending(status, ["raw_data"], "scraped_data")


def pending_clean(status: DataFrame) -> DataFrame:
    return pending(status, ["raw_data", "scraped_data"], "cleaned_data")


def pending_analysis(status: DataFrame) -> DataFrame:
    return pending(status, ["cleaned_data"], "llm_data")


def rows_of(rows: DataFrame, ids: DataFrame, key: str = "news_id") -> DataFrame:
    """Rows whose key is among ``ids``: a semi join, never a collected list."""
    return rows.join(ids.select(key), key, "left_semi")


def advance(status: DataFrame, processed: DataFrame, stage: str, key: str = "news_id") -> DataFrame:
    """Status with ``stage`` set for the processed keys; other rows unchanged."""
    keys = processed.select(F.col(key).alias("_done")).distinct()
    return (
        status.join(keys, F.col(key).eqNullSafe(F.col("_done")) & F.col("_done").isNotNull(), "left")
        .withColumn(stage, F.when(F.col("_done").isNotNull(), True).otherwise(F.col(stage)))
        .drop("_done")
    )
