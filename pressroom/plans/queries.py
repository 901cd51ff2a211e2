"""The registered queries: each operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from pressroom import fixed_values as V
from pressroom.functions import sentences as S
from pressroom.functions.arrays import explode_rows
from pressroom.functions.dates import request_range
from pressroom.functions.html import host, with_blocks, with_dense_text
from pressroom.functions.summary import with_centrality, with_sentence_scores, with_summary
from pressroom.functions.text import measure, token_count, with_clean_text, with_spam_score
from pressroom.operators import analysis, articles, boundaries, ingest, prices, scrape
from pressroom.operators import status as work
from pressroom.plans import analysis as analysis_plan
from pressroom.plans import standins as I
from pressroom.plans.news import import_landings, process_news
from pressroom.plans.prices import store_prices
from pressroom.schemas import FEED_ITEM, TableSpec
from pressroom.session import configure, scratch_dir, work_dir
from pressroom.sources import tables
from pressroom.sources.feed import feed_items, read_feed_pages, request_parameters
from pressroom.sources.analysis import write_requests
from pressroom.sources.prices import read_bars, read_prices, ticker_series
from pressroom.streaming.imports import start_import

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    _QUERIES[function.__name__] = run
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# -- text ------------------------------------------------------------------------------------


@query
def text_normalize(spark, sf):
    text = with_clean_text(I.documents(spark, sf).select("doc_id", "text"), "text", "text")
    return text.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"))


def _cleaned(docs, **options):
    text = with_clean_text(docs, "text", "text", **options)
    end = F.expr("right(text, 40)")
    return text.select("doc_id", F.md5("text").alias("text_md5"), end.alias("ending"))


@query
def text_repair(spark, sf):
    """All documents with right and garbled runs side by side, some garbled twice."""
    return _cleaned(I.appended(spark, sf, I.GARBLED))


@query
def text_scripts(spark, sf):
    """All documents with compatibility forms and other scripts."""
    return _cleaned(I.appended(spark, sf, I.SCRIPTS))


@query
def text_flags(spark, sf):
    """Links in capitals, and the options for addresses, numbers and punctuation."""
    return _cleaned(I.appended(spark, sf, I.MARKED), no_emails=True, no_numbers=True, no_punct=True)


@query
def text_measure(spark, sf):
    docs = measure(I.documents(spark, sf), "text")
    return docs.select("doc_id", "text_word_count", "text_token_count")


@query
def spam_score(spark, sf):
    scored = with_spam_score(I.documents(spark, sf), "text")
    return scored.select("doc_id", F.round("spam_score", 6).alias("spam_score"))


def _curated(spark, sf):
    docs = I.documents(spark, sf).select(
        "doc_id",
        F.col("text").alias("full_text"),
        F.lit(None).cast("string").alias("error"),
    )
    return articles.clean_full_text(docs)


@query
def curated_text(spark, sf):
    return _curated(spark, sf).select(
        "doc_id",
        F.md5("full_cleaned_text").alias("text_md5"),
        "error",
        F.round("spam_score", 6).alias("spam_score"),
    )


@query
def quality_report(spark, sf):
    return articles.quality_report(I.documents(spark, sf), "lang", "source")


@query
def best_text(spark, sf):
    """The next document stands in for the preview."""
    preview = I.table(spark, sf, "documents").select(
        (F.col("doc_id") - 1).alias("doc_id"), F.col("text").alias("preview_text")
    )
    both = measure(
        _curated(spark, sf).join(preview, "doc_id", "left"), "preview_text", "full_cleaned_text"
    )
    return articles.with_selected_text(both).select(
        "doc_id",
        "preview_text_word_count",
        "full_cleaned_text_word_count",
        F.md5("selected_text").alias("selected_md5"),
    )


@query
def article_features(spark, sf):
    """Documents as metadata, pages as scraped rows; the common columns are id and URL."""
    metadata = I.documents(spark, sf).select(
        F.col("doc_id").alias("news_id"),
        F.when(F.col("doc_id") % 5 != 0, F.concat(F.lit("u"), F.col("doc_id") % 7)).alias("news_url"),
        F.col("text").alias("preview_text"),
    )
    scraped = scrape.extract_text(I.pages(spark, sf), "page_id").select(
        F.col("page_id").alias("news_id"),
        F.when(F.col("page_id") % 5 != 0, F.concat(F.lit("u"), F.col("page_id") % 3)).alias("news_url"),
        F.col("full_text").alias("full_cleaned_text"),
    )
    joined = articles.natural_left_join(metadata, scraped)
    joined = measure(joined, "preview_text", "full_cleaned_text")
    chosen = measure(articles.with_selected_text(joined), "selected_text")
    return chosen.select(
        "news_id",
        "news_url",
        "full_cleaned_text_word_count",
        "selected_text_word_count",
        "selected_text_token_count",
    )


# -- ingest ----------------------------------------------------------------------------------


@query
def feed_dedup_first(spark, sf):
    first = ingest.keep_first(I.table(spark, sf, "events"), ["user_id", "event_type"], ["ts", "event_id"])
    return first.select("user_id", "event_type", "event_id", "ts", "value")


@query
def feed_pages_until_empty(spark, sf):
    """Nine tenths into the feed one page is empty, and what follows does not count."""
    pages = I.as_feed_pages(I.feed(spark, sf))
    gap = F.floor(F.col("total_pages") * 9 / 10)
    pages = pages.withColumn(
        "data", F.when(F.col("page") == gap, F.expr("slice(data, 1, 0)")).otherwise(F.col("data"))
    )
    return feed_items(pages).select("page", "pos", "ordinal", "news_id", "news_url")


def _landed_feed(spark, sf, of=3):
    """The feed as JSON landings, of which the second ends early; the path, and the pages of each."""
    path = scratch_dir(spark, "landings")
    items = I.feed(spark, sf)
    for k in range(of):
        mine = items.filter(F.col("news_id").cast("long") % of == k).withColumn("page", F.floor((F.col("page") - 1) / of) + 1)
        pages = I.as_feed_pages(mine.withColumn("page", F.col("page").cast("int")))
        if k == 1:
            gap = F.floor(F.col("total_pages") / 2)
            pages = pages.withColumn("data", F.when(F.col("page") == gap, F.expr("slice(data, 1, 0)")).otherwise(F.col("data")))
        yield path, pages.withColumn("page", F.col("page").cast("int"))


@query
def feed_landings(spark, sf):
    """Three landings imported one after the other, each by a run that sees all that have landed."""
    warehouse = tables.Warehouse(spark, work_dir(spark, "warehouse"))
    runs = []
    for k, (path, pages) in enumerate(_landed_feed(spark, sf)):
        pages.write.json(f"{path}/landed=2030-01-0{k + 1}")
        for again in (False, True):
            outcome = import_landings(warehouse, path, "2030-01-09 00:00:00")
            runs.append((k, again, outcome["n_rows"], outcome["n_landings"]))
    return spark.createDataFrame(runs, "run int, again boolean, n_rows bigint, n_landings bigint")


@query
def feed_dates(spark, sf):
    dated = ingest.drop_undated(ingest.with_dates(I.feed(spark, sf)))
    return dated.select("news_id", "date_utc", "year_utc", "month_utc", "day_utc")


@query
def feed_date_nulls(spark, sf):
    return ingest.undated_count(ingest.with_dates(I.feed(spark, sf)))


@query
def metadata_rows(spark, sf):
    rows = tables.normalize_lists(ingest.feed_to_metadata(I.feed(spark, sf)))
    return rows.select(
        "news_id",
        "date_utc",
        "news_url",
        F.round("rank_score", 6).alias("rank_score"),
        F.size("topics").alias("n_topics"),
        "title_text",
        F.md5("preview_text").alias("preview_md5"),
    )


@query
def high_water_mark(spark, sf):
    seen = I.table(spark, sf, "events").select(F.col("ts").alias("date_utc"))
    bounds = ingest.fetch_bounds(seen, "2024-02-01 03:00:00", "2023-01-01")
    return bounds.select(
        "start_date",
        "end_date",
        request_range(F.col("start_date"), F.col("end_date")).alias("date_range"),
    )


@query
def feed_request(spark, sf):
    seen = I.table(spark, sf, "events").select(F.col("ts").alias("date_utc"))
    bounds = ingest.fetch_bounds(seen, "2024-02-01 03:00:00", "2023-01-01")
    return request_parameters(bounds).withColumnRenamed("extra-fields", "extra_fields")


def _stored_and_fetched(spark, sf):
    feed = ingest.with_dates(I.feed(spark, sf))
    return (
        feed.where(F.col("date_utc") < "2024-01-20"),
        feed.where(F.col("date_utc") >= "2024-01-15"),
    )


@query
def new_rows_anti(spark, sf):
    stored, fetched = _stored_and_fetched(spark, sf)
    return ingest.new_rows(fetched, stored).select("news_id", "news_url", "date_utc")


@query
def new_status_rows(spark, sf):
    stored, fetched = _stored_and_fetched(spark, sf)
    return ingest.new_status(fetched, stored.select("news_id"))


# -- work state ------------------------------------------------------------------------------


def _pending_documents(spark, sf, choose):
    docs = I.table(spark, sf, "documents").withColumnRenamed("doc_id", "news_id")
    return work.rows_of(docs, choose(I.status(spark, sf))).select("news_id", "lang", "n_chars")


@query
def pending_scrape(spark, sf):
    return _pending_documents(spark, sf, work.pending_scrape)


@query
def pending_clean(spark, sf):
    return _pending_documents(spark, sf, work.pending_clean)


@query
def pending_analysis(spark, sf):
    return _pending_documents(spark, sf, work.pending_analysis)


@query
def status_advance(spark, sf):
    """Documents that also are pages count as processed."""
    done = I.table(spark, sf, "pages").select(F.col("page_id").alias("news_id"))
    return work.advance(I.status(spark, sf), done, "scraped_data")


# -- stored tables ---------------------------------------------------------------------------


def _order_halves(spark, sf):
    orders = I.table(spark, sf, "orders")
    newer = orders.where(F.col("o_orderdate") >= "1997-01-01").withColumn(
        "o_totalprice", F.round(F.col("o_totalprice") + 1, 2)
    )
    return orders.where(F.col("o_orderdate") < "1999-07-01"), newer


@query
def upsert(spark, sf):
    return tables.merge_rows(*_order_halves(spark, sf), "o_orderkey")


@query
def upsert_metrics(spark, sf):
    return tables.merge_counts(*_order_halves(spark, sf), "o_orderkey")


ORDERS = TableSpec(
    "orders",
    T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_totalprice", T.DoubleType()),
            T.StructField("o_orderdate", T.TimestampType()),
            T.StructField("year", T.IntegerType()),
        ]
    ),
    "orders",
    key="o_orderkey",
    partitions=["year"],
)


@query
def stored_upsert(spark, sf):
    """The same upsert on a stored table; some updated rows move to another partition."""
    older, newer = _order_halves(spark, sf)
    warehouse = tables.Warehouse(spark, work_dir(spark, "stored-upsert"), {"orders": ORDERS})
    year = F.year("o_orderdate")
    moved = F.when(F.col("o_orderkey") % 4 == 0, year + 1).otherwise(year)
    warehouse.write_table("orders", older.withColumn("year", year))
    warehouse.write_table("orders", newer.withColumn("year", moved))
    return warehouse.read_table("orders")


@query
def filtered_read(spark, sf):
    """Conjunction of filter tuples on a table scan."""
    keep = tables.filters_to_column([("o_orderstatus", "=", "F"), ("o_orderpriority", "in", ["1-URGENT", "2-HIGH"])])
    return I.table(spark, sf, "orders").where(keep).select("o_orderkey", "o_totalprice")


@query
def list_normalize(spark, sf):
    """Sentences of a turn as the list of its speaker; the other speaker's list is null."""
    said = S.split_sentences(F.col("text"))
    lists = I.table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "user", said).alias("asked"),
        F.when(F.col("role") == "assistant", said).alias("answered"),
    )
    return tables.normalize_lists(lists).select(
        "conv_id",
        "turn",
        F.size("asked").alias("n_asked"),
        F.size("answered").alias("n_answered"),
        F.md5(F.array_join("answered", "|")).alias("answer_md5"),
    )


# -- pages -----------------------------------------------------------------------------------


@query
def natural_left_join(spark, sf):
    docs = I.table(spark, sf, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 4 != 0, F.lit(1)).cast("int").alias("quality"), "n_chars"
    )
    labels = I.table(spark, sf, "labels").select(
        "doc_id", F.when(F.col("doc_id") % 4 != 0, F.col("quality")).alias("quality"), "toxic"
    )
    return articles.natural_left_join(docs, labels.where("doc_id is not null"))


@query
def url_left_join(spark, sf):
    """Events as metadata; the page with the user's number gives the URL, so URLs repeat."""
    urls = I.table(spark, sf, "pages").select(F.col("page_id").alias("user_id"), F.col("url").alias("news_url"))
    metadata = (
        I.table(spark, sf, "events")
        .join(urls, "user_id", "left")
        .select(
            F.col("event_id").alias("news_id"),
            "news_url",
            F.col("ts").alias("date_utc"),
            F.year("ts").alias("year_utc"),
            F.month("ts").alias("month_utc"),
            F.dayofmonth("ts").alias("day_utc"),
        )
    )
    outcomes = scrape.fetch_outcomes(I.fetched_pages(spark, sf))
    joined = scrape.join_outcomes(metadata, outcomes)
    return joined.select("news_id", "news_url", "day_utc", "status_code", "success")


@query
def distinct_urls(spark, sf):
    return scrape.distinct_urls(I.feed(spark, sf))


@query
def extract_text(spark, sf):
    text = scrape.extract_text(I.pages(spark, sf), "page_id")
    return text.select("page_id", F.md5("full_text").alias("text_md5"), F.length("full_text").alias("n_chars"))


@query
def extract_traps(spark, sf):
    """The text of all pages, unharmed by what is nested in them or never closed."""
    text = scrape.extract_text(I.trapped_pages(spark, sf), "page_id")
    return text.select("page_id", F.md5("full_text").alias("text_md5"), F.length("full_text").alias("n_chars"))


@query
def extract_density(spark, sf):
    """The densest run of blocks of all pages, half of them without article marks."""
    text = with_dense_text(I.unmarked_pages(spark, sf))
    return text.select("page_id", F.md5("full_text").alias("text_md5"), F.length("full_text").alias("n_chars"))


@query
def boilerplate_blocks(spark, sf):
    return scrape.boilerplate_blocks(
        with_blocks(I.pages(spark, sf).withColumn("host", host(F.col("url"))))
    )


@query
def extract_text_unrepeated(spark, sf):
    text = scrape.extract_text(I.pages(spark, sf), "page_id", min_pages=2)
    return text.select("page_id", F.md5("full_text").alias("text_md5"), F.length("full_text").alias("n_chars"))


@query
def fetch_outcome(spark, sf):
    outcomes = scrape.fetch_outcomes(I.fetched_pages(spark, sf))
    return outcomes.select(
        "news_url",
        F.md5("full_text").alias("text_md5"),
        "status_code",
        "error",
        "success",
        F.round("elapsed_time", 6).alias("elapsed_time"),
    )


@query
def fetch_summary(spark, sf):
    return scrape.fetch_summary(scrape.fetch_outcomes(I.fetched_pages(spark, sf)))


@query
def fetch_progress(spark, sf):
    """Ordinals far apart, as ids of many sources are."""
    outcomes = scrape.fetch_outcomes(I.fetched_pages(spark, sf), keep=["page_id"])
    sparse = outcomes.withColumn("ordinal", F.col("page_id") * 1_000_003)
    return scrape.fetch_progress(sparse, "ordinal")


# -- sentences and summaries -----------------------------------------------------------------


@query
def sentences(spark, sf):
    cut = I.documents(spark, sf).select("doc_id", S.split_sentences(F.col("text")).alias("sentences"))
    rows = explode_rows(cut, ["doc_id"], "sentences", "idx", "sentence")
    return rows.select(
        "doc_id", "idx", F.md5("sentence").alias("sentence_md5"), S.space_words(F.col("sentence")).alias("n_words")
    )


@query
def sentence_boundaries(spark, sf):
    """Abbreviations, sentence starters and collocations learned from all documents."""
    learned = boundaries.learn(I.abbreviated(spark, sf))

    def rows(df, kind, following):
        return df.select(
            F.lit(kind).alias("kind"), "type", following.alias("next_type"), F.round("score", 6).alias("score")
        )

    none = F.lit(None).cast("string")
    return (
        rows(learned.abbreviations, "abbreviation", none)
        .union(rows(learned.starters, "starter", none))
        .union(rows(learned.collocations, "collocation", F.col("next_type")))
    )


@query
def sentences_learned(spark, sf):
    """Sentences of all documents by learned boundaries."""
    docs = I.abbreviated(spark, sf)
    cut = boundaries.with_learned_sentences(docs, "doc_id", boundaries.learn(docs))
    rows = explode_rows(cut, ["doc_id"], "sentences", "idx", "sentence")
    return rows.select(
        "doc_id", "idx", F.md5("sentence").alias("sentence_md5"), S.space_words(F.col("sentence")).alias("n_words")
    )


@query
def summary_learned(spark, sf):
    """Summaries over sentences by learned boundaries."""
    docs = I.abbreviated(spark, sf)
    cut = boundaries.with_learned_sentences(docs, "doc_id", boundaries.learn(docs))
    out = with_summary(cut, "text", "summary", sentences="sentences")
    return out.select("doc_id", F.md5("summary").alias("summary_md5"), token_count(F.col("summary")).alias("n_tokens"))


@query
def sentence_weights(spark, sf):
    """Length quantile and weights, and position scores, of every sentence."""
    docs = I.documents(spark, sf).select("doc_id", S.split_sentences(F.col("text")).alias("sentences"))
    docs = docs.withColumn("n_words", S.sentence_words(F.col("sentences")))
    docs = docs.withColumn("q90", S.array_quantile(F.col("n_words"), V.LENGTH_QUANTILE))
    docs = docs.withColumn("weights", S.length_weights(F.col("n_words"), F.col("q90")))
    docs = docs.withColumn("n", F.size("n_words"))
    rows = explode_rows(docs, ["doc_id", "n", "q90"], "weights", "idx", "weight")
    intro, conclusion = S.position_scores(F.col("n"), F.col("idx"))
    return rows.select(
        "doc_id",
        "idx",
        F.round("q90", 6).alias("q90"),
        F.round("weight", 6).alias("weight"),
        intro.alias("intro"),
        conclusion.alias("conclusion"),
    )


@query
def dense_centrality(spark, sf):
    """Fifty consecutive vectors make a document; the label gives the sentence length."""
    vectors = I.table(spark, sf, "embeddings").select(
        F.floor(F.col("vec_id") / 50).alias("doc_id"),
        F.struct(F.col("vec_id"), "embedding", (F.col("label") + 1).alias("n_words")).alias("row"),
    )
    docs = vectors.groupBy("doc_id").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    docs = docs.select(
        "doc_id", F.col("rows.embedding").alias("vectors"), F.col("rows.n_words").alias("n_words")
    )
    scored = with_centrality(docs, "n_words", vectors="vectors")
    rows = explode_rows(scored, ["doc_id"], "centrality", "idx", "centrality")
    return rows.select("doc_id", "idx", F.round("centrality", 6).alias("centrality"))


@query
def tfidf_centrality(spark, sf):
    """Centrality and final score of every sentence of the long documents."""
    docs = I.documents(spark, sf).withColumn("n_tokens", token_count(F.col("text")))
    long_text = F.when(F.col("n_tokens") >= V.MAX_ARTICLE_TOKENS, F.col("text"))
    docs = docs.select("doc_id", S.split_sentences(long_text).alias("sentences"))
    enough = F.size("sentences") >= V.LOCAL_WINDOW
    docs = docs.withColumn("sentences", F.when(enough, F.col("sentences"))).select(
        "doc_id",
        S.sentence_words(F.col("sentences")).alias("n_words"),
        S.sentence_terms(F.col("sentences")).alias("terms"),
    )
    docs = with_sentence_scores(with_centrality(docs, "n_words", terms="terms"), "centrality", "score")
    rows = explode_rows(docs, ["doc_id"], F.arrays_zip("centrality", "score"), "idx", "row")
    return rows.select(
        "doc_id",
        "idx",
        F.round("row.centrality", 6).alias("centrality"),
        F.col("row.score").alias("score"),
    )


@query
def summary(spark, sf):
    docs = with_summary(I.documents(spark, sf), "text", "summary")
    return docs.select(
        "doc_id",
        F.md5("summary").alias("summary_md5"),
        token_count(F.col("summary")).alias("n_tokens"),
    )


# -- analysis requests and responses ---------------------------------------------------------


def _request_articles(spark, sf):
    return I.documents(spark, sf).select(
        F.col("doc_id").cast("string").alias("news_id"),
        F.concat_ws(" ", "lang", "source").alias("title_text"),
        F.col("text").alias("llm_ready_text"),
        "lang",
    )


@query
def prompt_messages(spark, sf):
    messages = analysis.with_messages(_request_articles(spark, sf))
    rows = explode_rows(messages, ["news_id"], "messages", "pos", "message")
    return rows.select("news_id", "pos", "message.role", F.md5("message.content").alias("content_md5"))


@query
def batch_requests(spark, sf):
    requests = analysis.batch_requests(_request_articles(spark, sf))
    return requests.select(
        "custom_id",
        "method",
        "url",
        F.col("body.model").alias("model"),
        F.col("body.temperature").alias("temperature"),
        F.col("body.max_tokens").alias("max_tokens"),
        F.size("body.messages").alias("n_messages"),
        "token_count",
    )


@query
def request_file(spark, sf):
    """Requests as lines of a file, read back as a model would."""
    path = scratch_dir(spark, "requests")
    write_requests(analysis.batch_requests(_request_articles(spark, sf)), path)
    message = "array<struct<role: string, content: string>>"
    body = f"struct<model: string, temperature: double, max_tokens: int, messages: {message}>"
    line = F.from_json("value", f"custom_id string, method string, url string, body {body}")
    return spark.read.text(path).select(line.alias("r")).select(
        "r.custom_id", "r.method", "r.url", "r.body.model", "r.body.temperature", "r.body.max_tokens",
        F.md5(F.array_join("r.body.messages.role", " ")).alias("roles_md5"),
        F.md5(F.element_at("r.body.messages.content", -1)).alias("content_md5"),
    )


@query
def unscraped_articles(spark, sf):
    """Documents met with a table that nobody has written: all of them, with nothing scraped."""
    warehouse = tables.Warehouse(spark, work_dir(spark, "warehouse"))
    metadata = I.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("news_id"), "source")
    scraped = warehouse.read_table("scraped_data", columns=["news_id", "full_text", "success"])
    return articles.natural_left_join(metadata, scraped).select(
        "news_id", "source", F.col("full_text").isNull().alias("no_text"), F.col("success").isNull().alias("no_outcome")
    )


@query
def batch_tokens(spark, sf):
    requests = analysis.batch_requests(_request_articles(spark, sf))
    lang = F.when(F.length("custom_id") <= 10, "short id").otherwise("long id")
    return analysis.batch_tokens(requests.withColumn("batch", lang), "batch")


@query
def parse_responses(spark, sf):
    valid = analysis.valid_responses(analysis.parse_responses(I.responses(spark, sf)))
    return valid.select(
        "batch_id",
        "news_id",
        "emotion_category",
        F.array_join("event_category", "|").alias("events"),
        *V.REQUIRED_SCORES,
        F.array_join("key_topics", "|").alias("topics"),
        "free_text_summary",
        "historical_analogy",
        "sentiment_warning",
    )


@query
def rejected_responses(spark, sf):
    return analysis.rejected_responses(analysis.parse_responses(I.responses(spark, sf))).drop("pos")


@query
def decode_single(spark, sf):
    """Event properties as single answers, some empty or cut off."""
    event = F.col("event_id")
    answers = I.table(spark, sf, "events").select(
        event,
        F.when(event % 5 == 0, "")
        .when(event % 7 == 0, F.substring("props", 1, 3))
        .otherwise(F.col("props"))
        .alias("content"),
    )
    return analysis.decode_single(answers).select("event_id", "decode_error", F.col("item").isNotNull().alias("decoded"))


# -- prices ----------------------------------------------------------------------------------


def _with_rounding(rows):
    return rows.select(
        "ticker", "date", *[F.round(c, 6).alias(c) for c in ("open", "high", "low", "close")], "volume"
    )


def _stored_bars(spark, sf):
    """Bars up to 20 January, at half value; one ticker has them all."""
    bars = I.bars(spark, sf).where((F.col("date") <= "2024-01-20") | (F.col("ticker") == "view-USD"))
    return bars.withColumns({c: F.col(c) / 2 for c in ("open", "high", "low", "close")})


@query
def price_bars(spark, sf):
    return _with_rounding(I.bars(spark, sf))


@query
def price_last_date(spark, sf):
    return prices.last_dates(_stored_bars(spark, sf))


@query
def price_stale(spark, sf):
    return prices.stale_tickers(_stored_bars(spark, sf), I.bars(spark, sf), "2024-01-30 12:00:00")


@query
def price_keep_last(spark, sf):
    newer = I.bars(spark, sf).where(F.col("date") >= "2024-01-15")
    return _with_rounding(prices.keep_last_bars(_stored_bars(spark, sf), newer))


@query
def price_refresh(spark, sf):
    return _with_rounding(
        prices.refreshed_prices(_stored_bars(spark, sf), I.bars(spark, sf), "2024-01-30 12:00:00")
    )


@query
def price_wide(spark, sf):
    kinds = ["click", "error", "purchase", "signup", "view"]
    wide = prices.wide_prices(I.bars(spark, sf), [f"{kind}-USD" for kind in kinds])
    fields = ["open", "high", "low", "close", "volume"]
    return wide.select(
        "date", *[F.round(f"`{field}_{kind}-USD`", 6).alias(f"{field}_{kind}") for kind in kinds for field in fields]
    )


@query
def price_files(spark, sf):
    """Landed bars, one ticker as CSV and all as Parquet, read within bounds of tickers and days."""
    path = scratch_dir(spark, "bars")
    bars = I.bars(spark, sf)
    bars.filter("ticker = 'click-USD'").write.option("header", True).csv(f"{path}/csv")
    bars.write.parquet(f"{path}/parquet")
    landed = read_bars(spark, f"{path}/csv", ["click-USD"], fmt="csv").withColumn("source", F.lit("csv"))
    rest = read_bars(spark, f"{path}/parquet", ["view-USD", "error-USD"], "2024-01-05", "2024-01-20")
    rows = landed.unionByName(rest.withColumn("source", F.lit("parquet")))
    return rows.select("source", "ticker", "date", *[F.round(c, 6).alias(c) for c in ("open", "high", "low", "close")], "volume")


@query
def price_one(spark, sf):
    return _with_rounding(ticker_series(I.bars(spark, sf), "click"))


@query
def price_flow(spark, sf):
    """Two refreshes of a stored series, then a read of all of it."""
    path = work_dir(spark, "price-flow")
    bars = I.bars(spark, sf)
    store_prices(spark, path, bars.where(F.col("date") <= "2024-01-20"), "2024-01-21 00:00:00")
    store_prices(spark, path, bars, "2024-01-31 00:00:00")
    return _with_rounding(read_prices(spark, path))


# -- whole runs ------------------------------------------------------------------------------


def _news_items(spark, sf):
    """Pages as feed items, a document of the same number as preview; ten days in turn."""
    page = F.col("page_id")
    stamp = F.timestamp_add("HOUR", (page % 240).cast("int"), F.lit("2024-01-01").cast("timestamp"))
    docs = I.table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), F.col("text").alias("preview"))
    return (
        I.table(spark, sf, "pages")
        .join(docs, "page_id", "left")
        .select(
            (F.floor(page / 100) + 1).cast("int").alias("page"),
            (page % 100).cast("int").alias("pos"),
            page.cast("string").alias("news_id"),
            F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"),
            F.lit("Article").alias("type"),
            host(F.col("url")).alias("source_name"),
            F.array(F.lit("BTC")).alias("tickers"),
            F.lit(None).cast("array<string>").alias("topics"),
            F.col("url").alias("news_url"),
            F.lit("1.5").alias("rank_score"),
            F.lit("Neutral").alias("sentiment"),
            F.concat(F.lit("Page "), page).alias("title"),
            F.col("preview").alias("text"),
        )
    )


def _news_run(spark, sf):
    folder = work_dir(spark, "news-flow")
    I.as_feed_pages(_news_items(spark, sf)).write.json(f"{folder}/landed")
    warehouse = tables.Warehouse(spark, f"{folder}/tables")
    landed = read_feed_pages(spark, f"{folder}/landed")
    stages = process_news(
        warehouse, landed, I.fetched_pages(spark, sf), "2024-02-01 00:00:00", "2024-01-01"
    )
    return warehouse, stages


@query
def news_flow(spark, sf):
    """Import, scrape and clean of all pages into stored tables; the cleaned rows."""
    warehouse, stages = _news_run(spark, sf)
    failed = stages.where("status = 'error'").first()
    if failed:
        raise RuntimeError(failed["error"])
    return warehouse.read_table("cleaned_data").select(
        "news_id",
        "date_utc",
        F.md5("selected_text").alias("selected_md5"),
        "selected_text_word_count",
        F.md5("llm_ready_text").alias("ready_md5"),
        "llm_ready_text_token_count",
    )


@query
def news_stages(spark, sf):
    """The stage results of the same run."""
    _, stages = _news_run(spark, sf)
    return stages


@query
def analysis_flow(spark, sf):
    """Documents as cleaned articles; their answers stored, and the work state after it."""
    warehouse = tables.Warehouse(spark, work_dir(spark, "analysis-flow"))
    day = (F.col("doc_id") % 10 + 1).cast("int")
    cleaned = I.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("news_id"),
        F.make_timestamp(F.lit(2024), F.lit(1), day, F.lit(0), F.lit(0), F.lit(0)).alias("date_utc"),
        F.lit(2024).alias("year_utc"),
        F.lit(1).alias("month_utc"),
        day.alias("day_utc"),
        F.col("text").alias("llm_ready_text"),
    )
    warehouse.write_table("cleaned_data", cleaned, unique=True)
    titled = I.table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("news_id"), F.concat_ws(" ", "lang", "source").alias("title_text"),
    )
    dated = cleaned.drop("llm_ready_text").join(titled, "news_id")
    warehouse.write_table("raw_data", dated, unique=True)
    ids = warehouse.read_table("cleaned_data", columns=["news_id"])
    done = {name: F.lit(name != "llm_data") for name in ("raw_data", "scraped_data", "cleaned_data", "llm_data")}
    warehouse.write_table("article_status_data", ids.withColumns(done), unique=True)
    analysis_plan.store_responses(warehouse, I.responses(spark, sf))
    status = warehouse.read_table("article_status_data")
    stored = warehouse.read_table("llm_data").select("news_id", "day_utc", "positive", "sentiment_warning")
    requests = analysis_plan.pending_requests(warehouse).select(
        F.expr("substring(custom_id, 9)").alias("news_id"), "token_count"
    )
    return status.select("news_id", "llm_data").join(stored, "news_id", "left").join(requests, "news_id", "left")


@query
def stream_import(spark, sf):
    """All documents' pages as a stream of feed items; the keys that end up stored."""
    folder = work_dir(spark, "stream-import")
    _news_items(spark, sf).drop("page", "pos").write.parquet(f"{folder}/landed")
    items = spark.readStream.schema(FEED_ITEM).parquet(f"{folder}/landed")
    warehouse = tables.Warehouse(spark, f"{folder}/tables")
    start_import(warehouse, items, f"{folder}/checkpoint").awaitTermination()
    return warehouse.read_table("raw_data").select("news_id", "news_url", "date_utc", "title_text")
