"""Request rows for the analysis model, and validation of its responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from pressroom import fixed_values as V
from pressroom.functions.text import token_count
from pressroom.schemas import ANALYSED, RESPONSE_ITEM


def user_message(news_id: Column, title: Column, text: Column) -> Column:
    """The user message of one article; a missing value is written as ``None``."""

    def shown(value: Column) -> Column:
        return F.coalesce(value.cast("string"), F.lit("None"))

    values = [shown(news_id), shown(title), shown(text), F.lit(V.ANALYSIS_REQUIREMENTS), shown(news_id)]
    parts = []
    for fixed, value in zip(V.USER_MESSAGE, values):
        parts += [F.lit(fixed), value]
    return F.concat(*parts, F.lit(V.USER_MESSAGE[-1]))


def with_messages(articles: DataFrame, out: str = "messages") -> DataFrame:
    """Add the chat messages as ``array<struct<role, content>>``."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    user = user_message(F.col("news_id"), F.col("title_text"), F.col("llm_ready_text"))
    return articles.withColumn(
        out, F.array(message("system", F.lit(V.SYSTEM_MESSAGE)), message("user", user))
    )


def batch_requests(articles: DataFrame, token_counter=token_count) -> DataFrame:
    """One request per article, with the estimated tokens of its messages."""
    body = F.struct(
        F.lit(V.MODEL_NAME).alias("model"),
        F.lit(V.MODEL_TEMPERATURE).alias("temperature"),
        F.lit(V.MODEL_MAX_TOKENS).alias("max_tokens"),
        F.col("messages"),
    )
    return with_messages(articles).select(
        F.concat(F.lit(V.CUSTOM_ID_PREFIX), F.col("news_id")).alias("custom_id"),
        F.lit(V.REQUEST_METHOD).alias("method"),
        F.lit(V.REQUEST_URL).alias("url"),
        body.alias("body"),
        token_counter(F.array_join(F.col("messages.content"), "\n")).alias("token_count"),
    )


def batch_tokens(requests: DataFrame, *groups: str) -> DataFrame:
    return requests.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum("token_count").alias("total_tokens")
    )


def _problems(item: Column) -> Column:
    """Array of what is wrong with a response item."""

    def missing(name: str, value: Column) -> Column:
        return F.when(value.isNull(), f"missing {name}")

    def member(name: str, allowed: list[str]) -> Column:
        return missing(name, item[name]).when(~item[name].isin(allowed), f"invalid {name}")

    def score(name: str, required: bool) -> Column:
        value = item[name]
        inside = F.coalesce(value.try_cast("double").between(0.0, 1.0), F.lit(False))
        result = F.when(value.isNotNull() & ~inside, f"invalid {name}")
        return result.when(value.isNull(), f"missing {name}") if required else result

    events = item["event_category"]
    strange = F.exists(events, lambda e: ~F.coalesce(e.isin(V.EVENT_CATEGORIES), F.lit(False)))
    return F.array_compact(
        F.array(
            missing("news_id", item["news_id"]),
            member("emotion_category", V.EMOTIONS),
            missing("event_category", events).when(strange, "invalid event_category"),
            member("price_direction_category", V.PRICE_DIRECTIONS),
            member("timeframe_category", V.TIMEFRAMES),
            *[score(name, True) for name in V.REQUIRED_SCORES],
            *[score(name, False) for name in V.OPTIONAL_SCORES],
            missing("key_topics", item["key_topics"]),
            missing("free_text_summary", F.coalesce(item["free_text_summary"], item["summary"])),
        )
    )


def _typed(item: Column) -> Column:
    """An item with its scores as numbers, one spelling of each field, and its problems."""
    scores = V.REQUIRED_SCORES + V.OPTIONAL_SCORES
    renamed = {
        "free_text_summary": F.coalesce(item["free_text_summary"], item["summary"]),
        "explain_reasoning_summary": F.coalesce(
            item["explain_reasoning_summary"], item["reasoning"]
        ),
    }
    fields = [
        item[name].try_cast("double") if name in scores else renamed.get(name, item[name])
        for name in RESPONSE_ITEM.names
    ]
    return F.struct(
        *[value.alias(name) for name, value in zip(RESPONSE_ITEM.names, fields)],
        _problems(item).alias("problems"),
    ).dropFields("summary", "reasoning")


def parse_responses(responses: DataFrame, strict: bool = False) -> DataFrame:
    """Typed analysis rows with ``problems``, an array of texts that is empty for a valid item.

    Expects ``batch_id, response_json`` with a JSON array per row; an unreadable one gives a
    single row. Scores may be numbers or quoted numbers. ``strict`` fails the job at the first
    invalid item, as a batch with one does in the original workflow. A sentiment that does not
    add up to one is only flagged.

    Items are checked inside the array, before it is exploded: as columns of a projection the
    checks would be copied into every later filter.
    """
    parsed = responses.select(
        "batch_id",
        F.try_parse_json("response_json").isNotNull().alias("_json"),
        F.from_json("response_json", T.ArrayType(RESPONSE_ITEM)).alias("_items"),
    ).select(
        "batch_id",
        (F.col("_json") & F.col("_items").isNotNull()).alias("_readable"),
        F.when(F.col("_json"), F.transform("_items", _typed)).alias("_items"),
    )
    items = (
        parsed.select("batch_id", "_readable", F.posexplode_outer("_items").alias("pos", "item"))
        .where(~F.col("_readable") | F.col("pos").isNotNull())
        .select("batch_id", "_readable", "pos", "item.*")
        .withColumn(
            "problems",
            F.when(~F.col("_readable"), F.array(F.lit("invalid JSON"))).otherwise(F.col("problems")),
        )
        .drop("_readable")
    )
    if strict:
        failure = F.concat(F.lit("Invalid response format: "), F.array_join("problems", "; "))
        items = items.where(F.assert_true(F.size("problems") == 0, failure).isNull())
    total = F.col("positive") + F.col("negative") + F.col("neutral")
    return items.withColumn(
        "sentiment_warning", F.coalesce(F.abs(total - 1) > 0.01, F.lit(False))
    )


def valid_responses(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.size("problems") == 0).drop("problems")


def rejected_responses(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.size("problems") > 0).select(
        "batch_id", "pos", "news_id", F.array_join("problems", "; ").alias("reason")
    )


def decode_single(responses: DataFrame, content: str = "content") -> DataFrame:
    """One response object per row: ``item`` and ``decode_error``."""
    text = F.col(content)
    return responses.withColumns(
        {
            "decode_error": F.when(
                F.coalesce(text, F.lit("")) == "", "Empty response from API"
            ).when(F.try_parse_json(text).isNull(), "API response is not valid JSON"),
        }
    ).withColumn("item", F.when(F.col("decode_error").isNull(), F.from_json(text, RESPONSE_ITEM)))


def analysed_rows(valid: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Valid responses with the dates of their articles; see ``unknown_responses`` for the others."""
    dates = cleaned.select("news_id", "date_utc", "year_utc", "month_utc", "day_utc")
    return valid.join(dates, "news_id").select(*ANALYSED.names)


def unknown_responses(valid: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Valid responses whose id has no article, shaped as rejected ones."""
    return valid.join(cleaned.select("news_id"), "news_id", "left_anti").select(
        "batch_id", "pos", "news_id", F.lit("no article with this id").alias("reason")
    )
