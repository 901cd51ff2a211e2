"""From metadata and scraped text to cleaned articles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from pressroom import fixed_values as V
from pressroom.functions.summary import with_summary
from pressroom.functions.text import curate, measure, token_count, with_clean_text
from pressroom.schemas import CLEANED


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on all common columns; null matches null."""
    common = [name for name in left.columns if name in right.columns]
    renamed = right.withColumnsRenamed({name: f"_r_{name}" for name in common})
    matches = reduce(
        lambda a, b: a & b, [F.col(name).eqNullSafe(F.col(f"_r_{name}")) for name in common]
    )
    return left.join(renamed, matches, "left").drop(*[f"_r_{name}" for name in common])


def clean_full_text(articles: DataFrame, out: str = "full_cleaned_text") -> DataFrame:
    """Clean and curate ``full_text``; adds ``out`` and ``spam_score``, updates ``error``."""
    return curate(with_clean_text(articles, "full_text", out), out)


def with_selected_text(
    df: DataFrame,
    preview: str = "preview_text",
    full: str = "full_cleaned_text",
    out: str = "selected_text",
) -> DataFrame:
    """The preview where it has more words than the full text and enough of them; else the full
    text. Expects ``<column>_word_count`` columns."""
    preview_words, full_words = F.col(f"{preview}_word_count"), F.col(f"{full}_word_count")
    longer = F.coalesce(preview_words, F.lit(0)) > F.coalesce(full_words, F.lit(0))
    enough = F.coalesce(preview_words >= V.MIN_ARTICLE_WORDS, F.lit(False))
    return df.withColumn(out, F.when(longer & enough, F.col(preview)).otherwise(F.col(full)))


def clean_articles(
    articles: DataFrame,
    *,
    clean_preview: bool = False,
    embed=None,
    token_counter=token_count,
    sentence_counter=None,
    compat: bool = False,
) -> DataFrame:
    """Cleaned rows of joined metadata and scraped text; one row out per row in, no shuffle.

    A long preview is taken as it is, even when the full text was rejected as spam, unless
    ``clean_preview``.
    """
    if clean_preview:
        articles = with_clean_text(articles, "preview_text", "preview_text")
    df = clean_full_text(articles)
    df = measure(df, "preview_text", "full_cleaned_text", token_counter=token_counter)
    df = with_selected_text(df)
    df = with_summary(
        df,
        "selected_text",
        "llm_ready_text",
        embed=embed,
        token_counter=token_counter,
        sentence_counter=sentence_counter,
        compat=compat,
    )
    df = measure(df, "selected_text", "llm_ready_text", token_counter=token_counter)
    return df.select(*CLEANED.names)


def quality_report(documents: DataFrame, *groups: str) -> DataFrame:
    """Counts of kept, short and spam texts and size figures per group."""
    df = documents.select(*groups, "text", F.lit(None).cast("string").alias("error"))
    df = curate(with_clean_text(df, "text", "text"), "text")
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.col("text").isNotNull()).alias("n_kept"),
        F.count_if(F.col("error") == "text too short").alias("n_short"),
        F.count_if(F.col("error") == "high spam score").alias("n_spam"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("kept_chars"),
        F.round(F.max("spam_score"), 6).alias("max_spam_score"),
    )
