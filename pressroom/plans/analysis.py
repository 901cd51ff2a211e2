"""The analysis stage around an outside model: requests out, responses in."""

from __future__ import annotations

from pyspark.sql import DataFrame

from pressroom.operators.analysis import (
    analysed_rows,
    batch_requests,
    parse_responses,
    rejected_responses,
    unknown_responses,
    valid_responses,
)
from pressroom.operators.status import advance, pending_analysis, rows_of
from pressroom.sources.tables import Warehouse


def pending_requests(warehouse: Warehouse) -> DataFrame:
    """Requests for cleaned articles without an analysis that have a text to analyse."""
    todo = pending_analysis(warehouse.read_table("article_status_data"))
    articles = rows_of(
        warehouse.read_table("cleaned_data", columns=["news_id", "llm_ready_text"]), todo
    ).where("llm_ready_text is not null")
    titles = warehouse.read_table("raw_data", columns=["news_id", "title_text"])
    return batch_requests(articles.join(titles, "news_id", "left"))


def store_responses(warehouse: Warehouse, responses: DataFrame, strict: bool = False) -> DataFrame:
    """Store valid analyses, mark their articles, and return the rejected items, unknown ids among them."""
    parsed = parse_responses(responses, strict)
    cleaned = warehouse.read_table("cleaned_data")
    warehouse.write_table(
        "llm_data",
        analysed_rows(valid_responses(parsed), cleaned),
        order_by=["confidence_score", "free_text_summary"],
    )
    todo = pending_analysis(warehouse.read_table("article_status_data"))
    done = warehouse.read_table("llm_data", columns=["news_id"])
    warehouse.write_table(
        "article_status_data", advance(rows_of(todo, done), done, "llm_data"), unique=True
    )
    return rejected_responses(parsed).unionByName(unknown_responses(valid_responses(parsed), cleaned))
