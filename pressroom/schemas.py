"""Table catalogue: declared schemas, keys and partition columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from pressroom.fixed_values import OPTIONAL_SCORES, REQUIRED_SCORES


_TYPES = {
    "STRING": T.StringType(),
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
    "BOOLEAN": T.BooleanType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """``name TYPE, ...`` to a schema; unlike Spark's DDL parser this needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


DATE_PARTS = ["year_utc", "month_utc", "day_utc"]
_DATE_DDL = "date_utc TIMESTAMP, year_utc INT, month_utc INT, day_utc INT"

FEED_ITEM = _schema(
    "news_id STRING, date STRING, type STRING, source_name STRING, tickers ARRAY<STRING>, "
    "topics ARRAY<STRING>, news_url STRING, rank_score STRING, sentiment STRING, title STRING, "
    "text STRING"
)
FEED_PAGE = T.StructType(
    [
        T.StructField("page", T.IntegerType()),
        T.StructField("total_pages", T.IntegerType()),
        T.StructField("data", T.ArrayType(FEED_ITEM)),
    ]
)
FETCHED_PAGE = _schema(
    "news_url STRING, html STRING, status_code INT, error_kind STRING, error STRING, "
    "elapsed_time DOUBLE"
)
METADATA = _schema(
    f"news_id STRING, date STRING, {_DATE_DDL}, type STRING, source_name STRING, "
    "tickers ARRAY<STRING>, topics ARRAY<STRING>, news_url STRING, rank_score DOUBLE, "
    "news_api_sentiment STRING, title_text STRING, preview_text STRING"
)
SCRAPED = _schema(
    f"news_id STRING, news_url STRING, {_DATE_DDL}, full_text STRING, status_code INT, "
    "error STRING, success BOOLEAN, elapsed_time DOUBLE"
)
CLEANED = _schema(
    f"news_id STRING, date STRING, {_DATE_DDL}, selected_text STRING, "
    "selected_text_word_count INT, selected_text_token_count INT, llm_ready_text STRING, "
    "llm_ready_text_word_count INT, llm_ready_text_token_count INT"
)
_SCORES_DDL = ", ".join(f"{name} DOUBLE" for name in REQUIRED_SCORES + OPTIONAL_SCORES)
ANALYSED = _schema(
    f"news_id STRING, {_DATE_DDL}, emotion_category STRING, event_category ARRAY<STRING>, "
    f"price_direction_category STRING, timeframe_category STRING, {_SCORES_DDL}, "
    "key_topics ARRAY<STRING>, free_text_summary STRING, explain_reasoning_summary STRING, "
    "historical_analogy STRING, risk_factors ARRAY<STRING>, sentiment_warning BOOLEAN"
)
STATUS = _schema(
    "news_id STRING, raw_data BOOLEAN, scraped_data BOOLEAN, cleaned_data BOOLEAN, "
    "llm_data BOOLEAN"
)
LANDING = _schema("landing STRING, n_files BIGINT, imported_at TIMESTAMP")
PRICE_BAR = _schema(
    "ticker STRING, date DATE, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume BIGINT"
)
# Leaf values are read as text: models quote their numbers as often as not.
RESPONSE_ITEM = _schema(
    "news_id STRING, emotion_category STRING, event_category ARRAY<STRING>, "
    "price_direction_category STRING, timeframe_category STRING, "
    + ", ".join(f"{name} STRING" for name in REQUIRED_SCORES + OPTIONAL_SCORES)
    + ", key_topics ARRAY<STRING>, free_text_summary STRING, summary STRING, "
    "explain_reasoning_summary STRING, reasoning STRING, historical_analogy STRING, "
    "risk_factors ARRAY<STRING>"
)


@dataclass(frozen=True)
class TableSpec:
    """A stored table. Without partition columns its rows are spread over key buckets."""

    name: str
    schema: T.StructType
    path: str
    key: str = "news_id"
    partitions: list[str] = field(default_factory=list)
    buckets: int = 8


TABLES = {
    spec.name: spec
    for spec in [
        TableSpec("article_status_data", STATUS, "process_status"),
        TableSpec("raw_data", METADATA, "raw_data", partitions=DATE_PARTS),
        TableSpec("scraped_data", SCRAPED, "scraped_data", partitions=DATE_PARTS),
        TableSpec("cleaned_data", CLEANED, "cleaned_data", partitions=DATE_PARTS),
        TableSpec("feed_landings", LANDING, "feed_landings", key="landing"),
        TableSpec("llm_data", ANALYSED, "analysis", partitions=DATE_PARTS),
    ]
}
