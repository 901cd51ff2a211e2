"""The news stages: import, scrape, clean; each reads its pending work and writes its table."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, Row, functions as F

from pressroom.functions.dates import percent_text, range_text
from pressroom.operators.articles import clean_articles, natural_left_join
from pressroom.operators.ingest import feed_to_metadata, fetch_bounds, new_rows, new_status
from pressroom.operators.scrape import (
    distinct_urls,
    fetch_outcomes,
    first_per_url,
    join_outcomes,
)
from pressroom.operators.status import advance, pending_clean, pending_scrape, rows_of
from pressroom.sources.feed import feed_items, landed_files, read_feed_pages
from pressroom.sources.tables import Warehouse

STAGE_RESULT = (
    "stage string, status string, n_rows bigint, n_success bigint, success_rate string, "
    "date_range string, error string"
)


def import_news(
    warehouse: Warehouse, pages: DataFrame, now: str, start_date: str | None = None
) -> dict:
    """Landed feed pages to new metadata rows, and a status row for each.

    Status rows are made for every stored article without one, so a run that died between the
    two writes is made good by the next.
    """
    bounds = fetch_bounds(warehouse.read_table("raw_data", columns=["date_utc"]), now, start_date)
    date_range = bounds.select(range_text(F.col("start_date"), F.col("end_date"))).first()[0]
    stored = warehouse.read_table("raw_data", columns=["news_id"])
    fresh = new_rows(feed_to_metadata(feed_items(pages)), stored)
    counts = warehouse.write_table("raw_data", fresh, order_by=["ordinal"])
    metadata = warehouse.read_table("raw_data", columns=["news_id"])
    status = warehouse.read_table("article_status_data", columns=["news_id"])
    warehouse.write_table("article_status_data", new_status(metadata, status), unique=True)
    return {"n_rows": counts["rows_inserted"], "date_range": date_range}


def import_landings(warehouse: Warehouse, path: str, now: str, start_date: str | None = None) -> dict:
    """Landings below ``path`` that no earlier run has imported, to metadata and status rows.

    Files are listed and set against the table of landings before any is read, and folders
    ``landed=YYYY-MM-DD`` before the day that the stored articles ask for are left out. Landings are
    noted last, so a run that died in between is made good by the next. What reaches the driver is
    the list of new files, as for any read.
    """
    spark = warehouse.spark
    stored = warehouse.read_table("raw_data", columns=["date_utc"])
    first_day = fetch_bounds(stored, now, start_date).select(F.date_format("start_date", "yyyy-MM-dd")).first()[0]
    known = warehouse.read_table("feed_landings", columns=["landing"])
    files = landed_files(spark, path, first_day).join(known, "landing", "left_anti")
    found = files.collect()
    if not found:
        return {"n_rows": 0, "n_landings": 0}
    outcome = import_news(warehouse, read_feed_pages(spark, path, files=[row["file"] for row in found]), now, start_date)
    sizes = Counter(row["landing"] for row in found)
    landings = spark.createDataFrame(list(sizes.items()), "landing string, n_files bigint")
    warehouse.write_table("feed_landings", landings.withColumn("imported_at", F.lit(now).cast("timestamp")), unique=True)
    return {**outcome, "n_landings": len(sizes)}


def scrape_articles(warehouse: Warehouse, fetched: DataFrame) -> dict:
    """Outcomes of landed fetches for the pending articles.

    An article is marked as scraped whatever its outcome; one whose page has not landed yet, or
    that has no URL, stays pending.
    """
    todo = pending_scrape(warehouse.read_table("article_status_data"))
    metadata = warehouse.read_rows_of("raw_data", todo)
    urls = distinct_urls(metadata).withColumnRenamed("news_url", "_url")
    same_url = F.col("news_url") == F.col("_url")
    wanted = fetched.join(urls, same_url, "left_semi")
    landed = metadata.join(
        fetched.select(F.col("news_url").alias("_url")).distinct(), same_url, "left_semi"
    )
    articles = join_outcomes(landed, fetch_outcomes(first_per_url(wanted)))
    warehouse.write_table("scraped_data", articles, unique=True)

    # Figures come from the stored rows, so that extraction runs once.
    todo = pending_scrape(warehouse.read_table("article_status_data"))
    stored = warehouse.read_table("scraped_data", columns=["news_id", "news_url", "success"])
    done = rows_of(stored, todo)
    figures = (
        done.groupBy("news_url")
        .agg(F.bool_or("success").alias("success"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if("success").alias("n_success"))
        .withColumn(
            "success_rate",
            F.when(F.col("n_rows") > 0, percent_text(F.col("n_success"), F.col("n_rows"))),
        )
        .first()
    )
    warehouse.write_table(
        "article_status_data", advance(todo, done, "scraped_data"), unique=True
    )
    return figures.asDict()


def clean_pending(warehouse: Warehouse, **options) -> dict:
    """Cleaned rows for the pending articles; ``options`` go to ``clean_articles``."""
    todo = pending_clean(warehouse.read_table("article_status_data"))
    metadata = warehouse.read_rows_of("raw_data", todo)
    scraped = warehouse.read_rows_of("scraped_data", todo)
    cleaned = clean_articles(natural_left_join(metadata, scraped), **options)
    counts = warehouse.write_table("cleaned_data", cleaned, unique=True)
    todo = pending_clean(warehouse.read_table("article_status_data"))
    done = rows_of(warehouse.read_table("cleaned_data", columns=["news_id"]), todo)
    warehouse.write_table(
        "article_status_data", advance(todo, done, "cleaned_data"), unique=True
    )
    return {"n_rows": counts["rows_inserted"] + counts["rows_updated"]}


def process_news(
    warehouse: Warehouse,
    pages: DataFrame,
    fetched: DataFrame,
    now: str,
    start_date: str | None = None,
    **clean_options,
) -> DataFrame:
    """All stages in order; one result row per stage. A failing stage ends the run with a row
    that names the error."""
    stages = [
        ("import", lambda: import_news(warehouse, pages, now, start_date)),
        ("scrape", lambda: scrape_articles(warehouse, fetched)),
        ("clean", lambda: clean_pending(warehouse, **clean_options)),
    ]
    names = [column.split()[0] for column in STAGE_RESULT.split(", ")]
    results = []
    for stage, run in stages:
        try:
            outcome = {"status": "success", **run()}
        except Exception as error:  # the run ends here; the caller sees the message
            outcome = {"status": "error", "error": str(error)}
        results.append(Row(*[{"stage": stage, **outcome}.get(name) for name in names]))
        if outcome["status"] == "error":
            break
    return warehouse.spark.createDataFrame(results, STAGE_RESULT)
