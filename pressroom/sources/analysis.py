"""Request and response files of the analysis model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def write_requests(requests: DataFrame, path: str) -> None:
    """One JSON request per line."""
    requests.select(
        F.to_json(F.struct("custom_id", "method", "url", "body")).alias("value")
    ).write.mode("overwrite").text(path)


def read_responses(spark: SparkSession, path: str) -> DataFrame:
    """Response texts, one JSON array per line, as ``batch_id, response_json``."""
    return spark.read.text(path).select(
        F.sha2("value", 256).alias("batch_id"), F.col("value").alias("response_json")
    )
