"""Fetch outcomes, their join with metadata, and success figures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from pressroom import fixed_values as V
from pressroom.functions.arrays import explode_rows
from pressroom.functions.dates import percent_text
from pressroom.functions.html import host, with_blocks, with_fallback, with_text
from pressroom.operators.ingest import keep_first
from pressroom.operators.numbering import numbered
from pressroom.schemas import DATE_PARTS
from pressroom.session import scratch_dir


def distinct_urls(metadata: DataFrame) -> DataFrame:
    return metadata.select("news_url").distinct()


def fetch_outcomes(fetched: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One result row per fetched page: text, status, error and success, and columns to ``keep``.

    ``error_kind`` of the input: null (answered), ``http``, ``request``, ``other``, or
    ``outside`` for a failure around the fetch itself.
    """
    kind, answered = F.col("error_kind"), F.col("error_kind").isNull()
    empty_body = F.coalesce(F.col("html"), F.lit("")) == ""
    text = with_text(
        fetched.withColumn("_html", F.when(answered & ~empty_body, F.col("html"))), "_html"
    )
    return text.select(
        "news_url",
        "full_text",
        F.when(kind == "request", 503)
        .when(kind == "other", 500)
        .when(kind == "outside", F.lit(None))
        .otherwise(F.col("status_code"))
        .cast("int")
        .alias("status_code"),
        F.when(answered & empty_body, "empty response")
        .when(kind == "outside", F.concat(F.lit("Error: "), F.col("error")))
        .when(~answered, F.col("error"))
        .alias("error"),
        F.coalesce(answered & (F.col("full_text") != ""), F.lit(False)).alias("success"),
        F.when(kind == "outside", 0.0).otherwise(F.col("elapsed_time")).alias("elapsed_time"),
        *keep,
    )


def first_per_url(fetched: DataFrame) -> DataFrame:
    """One fetch per URL: an answered one if there is any, then the quickest."""
    order = [F.col("error_kind").isNotNull(), F.col("elapsed_time"), F.md5("html")]
    return keep_first(fetched, ["news_url"], order)


def join_outcomes(metadata: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Metadata with the outcome of its URL; many rows may share a URL, and one without URL has none.

    The key is the plain URL, by which ``first_per_url`` has dealt the outcomes already. A URL that
    most rows share is split by adaptive skew handling; outcomes are unique per URL,
    so no row multiplies.
    """
    right = outcomes.withColumnRenamed("news_url", "_url")
    return (
        metadata.select("news_id", "news_url", "date_utc", *DATE_PARTS)
        .join(right, F.col("news_url") == F.col("_url"), "left")
        .drop("_url")
    )


def fetch_summary(outcomes: DataFrame) -> DataFrame:
    """Articles, successes and success rate text."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("articles_scraped"),
        F.count_if("success").alias("successful_scrapes"),
    ).withColumn(
        "success_rate",
        F.when(
            F.col("articles_scraped") > 0,
            percent_text(F.col("successful_scrapes"), F.col("articles_scraped")),
        ),
    )


def fetch_progress(outcomes: DataFrame, ordinal: str) -> DataFrame:
    """Successes per chunk of 100 URLs in order, and the running totals.

    Running totals over chunks are added up in two levels, so that neither level is one big sort.
    """
    chunks = (
        numbered(outcomes, [ordinal], "_number")
        .withColumn("chunk", F.floor(F.col("_number") / V.FETCH_CHUNK))
        .groupBy("chunk")
        .agg(
            F.count(F.lit(1)).alias("chunk_size"),
            F.count_if("success").alias("chunk_success"),
        )
        .withColumn("_group", F.floor(F.col("chunk") / 10_000))
    )
    groups = chunks.groupBy("_group").agg(
        F.sum("chunk_size").alias("_size"), F.sum("chunk_success").alias("_success")
    )
    before = Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select(
        "_group",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_size_before"),
        F.coalesce(F.sum("_success").over(before), F.lit(0)).alias("_success_before"),
    )
    running = (
        Window.partitionBy("_group")
        .orderBy("chunk")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        chunks.withColumn("_size", F.sum("chunk_size").over(running))
        .withColumn("_success", F.sum("chunk_success").over(running))
        .join(starts, "_group")
        .select(
            "chunk",
            "chunk_size",
            "chunk_success",
            (F.col("_size_before") + F.col("_size")).alias("total_done"),
            (F.col("_success_before") + F.col("_success")).alias("total_success"),
        )
        .withColumn("success_rate", percent_text(F.col("total_success"), F.col("total_done")))
    )


def boilerplate_blocks(pages: DataFrame, min_pages: int = 2) -> DataFrame:
    """Text blocks that occur on at least ``min_pages`` pages of one host.

    Expects ``host`` and ``blocks``. A block counts once per page, and counts are added up before
    the shuffle, so a footer on every page of a large host is no hot spot.
    """
    hashes = F.array_distinct(F.transform("blocks", F.md5))
    return count_blocks(explode_rows(pages, ["host"], hashes, "_pos", "block_md5"), min_pages)


def count_blocks(rows: DataFrame, min_pages: int) -> DataFrame:
    return (
        rows.groupBy("host", "block_md5")
        .agg(F.count(F.lit(1)).alias("n_pages"))
        .where(F.col("n_pages") >= min_pages)
    )


def extract_text(
    pages: DataFrame, key: str, url: str = "url", min_pages: int | None = None
) -> DataFrame:
    """``key, full_text`` of a table of pages with ``html``.

    With ``min_pages`` blocks repeated on that many pages of a host are left out first. The cut
    pages are then written to the shared folder once; finding the repeated blocks reads hashes
    only, and the texts meet the list once per page, by ``key``, which must be unique.
    """
    if min_pages is None:
        return with_text(pages).select(key, "full_text")
    spark = pages.sparkSession
    path = scratch_dir(spark, "cut-pages")
    hashes = F.transform("blocks", F.md5)
    (
        with_blocks(pages.withColumn("host", host(F.col(url))))
        .select(key, "host", "blocks", hashes.alias("hashes"), "_paragraphs")
        .write.parquet(path)
    )
    cut = spark.read.parquet(path)
    own = explode_rows(cut, [key, "host"], F.array_distinct("hashes"), "_pos", "block_md5")
    repeated = count_blocks(own, min_pages)
    hits = (
        own.join(repeated, ["host", "block_md5"], "left_semi")
        .groupBy(key)
        .agg(F.collect_set("block_md5").alias("_repeated"))
    )
    joined = cut.join(hits, key, "left")
    # The set comes from the join as it is, so the lambda repeats no work.
    kept = F.transform(
        F.filter(
            F.zip_with("blocks", "hashes", lambda b, h: F.struct(b.alias("block"), h.alias("md5"))),
            lambda item: ~F.array_contains(F.col("_repeated"), item["md5"]),
        ),
        lambda item: item["block"],
    )
    whole = F.col("_repeated").isNull()
    blocks = F.when(whole, F.col("blocks")).otherwise(kept)
    return with_fallback(joined.withColumn("blocks", blocks)).select(key, "full_text")
