"""Reference-shaped inputs derived from the driver tables, over all of their rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from pressroom import fixed_values as V
from pressroom.operators.prices import daily_bars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give text work as many tasks as the cluster has cores when the files are fewer.

    A large table has more scan tasks than cores and is not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    # The test files have one row group each, so that their other splits read nothing.
    return df.repartition(2 * cores, key) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"), "doc_id")


def abbreviated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that begin with titles, initials, numbers and abbreviations, by id."""
    kind = F.col("doc_id") % 4
    head = (
        F.when(kind == 0, "Mr. Brown of the U.S. office met J. Adams on no. 5 of the list. The talk ended. ")
        .when(kind == 1, "Dr. Green paid 5. The rest went to Mr. White and Mr. Brown. \"It is done.\" The U.S. The end. ")
        .when(kind == 2, "It costs 5. or less, etc. and J. Smith left... Then the U.S. market closed. The (small) no. 7 won! ")
        .otherwise("")
    )
    return documents(spark, sf_dir).select("doc_id", F.concat(head, "text").alias("text"))


#: Text appended to documents by id: garbled, in other scripts, and with links, addresses and numbers.
GARBLED = [" Ã©tÃ© déjà, ÃƒÂ©tude! â€œokâ€\x9d naïve «É»", " Ð‘Ð¸Ñ‚ÐºÐ¾Ð¸Ð½ é Ã¼ber æ¯”ç‰¹"]
SCRIPTS = [" Chapter Ⅳ costs ⅔ of № 5 at 20℃ ‥ end ＡＢＣ", " Биткоин растёт, Ελλάδα 比特币 한국 カタカナ ok ﬁn"]
MARKED = [" See HTTP://A.example/x?y=1 or WWW.b.example now", " mail a.b@c.example or pay 12,345.67 for 3!"]


def appended(spark: SparkSession, sf_dir: str, tails: list[str]) -> DataFrame:
    """Documents with one of two tails, by id."""
    tail = F.when(F.col("doc_id") % 2 == 0, tails[0]).otherwise(tails[1])
    return documents(spark, sf_dir).select("doc_id", F.concat("text", tail).alias("text"))


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id")


def trapped_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with nested boxes, tables and lists to drop in their articles, or 100 KB of comments never closed."""
    kind = F.col("page_id") % 5
    trap = (
        F.when(kind == 0, '<div class="ad"><div>Buy</div><p>Leaked promo text.</p></div>')
        .when(kind == 1, "<table><tr><td><table><tr><td>In</td></tr></table>Out</td></tr></table>")
        .when(kind == 2, "<section id='sponsored'><section>One</section>Two words</section>")
        .when(kind == 3, "<!-- <p>hidden > text</p> --><ul class='x nav-list'><li><ul><li>Deep</li></ul></li><li>More</li></ul>")
        .otherwise("")
    )
    html = F.replace("html", F.lit("</article>"), F.concat(trap, F.lit("</article>")))
    tail = F.when(kind == 4, F.repeat(F.lit("<!-- "), 20_000)).otherwise("")
    return pages(spark, sf_dir).select("page_id", F.concat(html, tail).alias("html"))


def unmarked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of which every second one marks its article by a plain box."""
    plain = F.replace(F.replace("html", F.lit("<article"), F.lit("<div")), F.lit("</article"), F.lit("</div"))
    html = F.when(F.col("page_id") % 2 == 0, plain).otherwise(F.col("html"))
    return pages(spark, sf_dir).select("page_id", html.alias("html"))


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as feed items: page and position by id; every 97th date is unreadable; ISO and
    RFC 2822 dates by turns; URLs repeat."""
    event, stamp = F.col("event_id"), F.col("ts")
    iso = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rfc = F.concat(
        F.date_format(stamp - F.expr("INTERVAL 5 HOURS"), "EEE, dd MMM yyyy HH:mm:ss"),
        F.lit(" -0500"),
    )
    return table(spark, sf_dir, "events").select(
        (F.floor(event / 100) + 1).cast("int").alias("page"),
        (event % 100).cast("int").alias("pos"),
        ((F.floor(event / 100) + 1) * 100 + event % 100).alias("ordinal"),
        event.cast("string").alias("news_id"),
        F.when(event % 97 == 0, "no date").when(event % 2 == 0, iso).otherwise(rfc).alias("date"),
        F.col("event_type").alias("type"),
        F.concat(F.lit("src"), F.col("user_id") % 20).alias("source_name"),
        F.array(F.lit("BTC")).alias("tickers"),
        F.when(event % 3 != 0, F.array("event_type")).alias("topics"),
        F.concat_ws(
            "/", F.lit("https://news.example"), "user_id", "event_type", event % 10
        ).alias("news_url"),
        F.col("value").cast("string").alias("rank_score"),
        F.lit("Neutral").alias("sentiment"),
        F.concat(F.lit("Title "), event).alias("title"),
        F.col("props").alias("text"),
    )


ITEM_FIELDS = [
    "news_id", "date", "type", "source_name", "tickers", "topics", "news_url", "rank_score",
    "sentiment", "title", "text",
]


def as_feed_pages(items: DataFrame) -> DataFrame:
    """Items gathered into pages; ids are unique, so a page has at most 100 of them."""
    item = F.struct("pos", F.struct(*ITEM_FIELDS).alias("item"))
    data = F.transform(F.sort_array(F.collect_list(item)), lambda entry: entry["item"])
    gathered = items.groupBy("page").agg(data.alias("data"))
    total = items.agg(F.max("page").alias("total_pages"))
    return gathered.select("page", total.scalar().alias("total_pages"), "data")


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as fetches with every kind of outcome, by page id."""
    kind = F.col("page_id") % 11
    return pages(spark, sf_dir).select(
        "page_id",
        F.col("url").alias("news_url"),
        F.when(kind == 4, "")
        .when(kind == 5, "<html><body><div></div></body></html>")
        .otherwise(F.col("html"))
        .alias("html"),
        F.when(kind == 0, 404).when(kind.isin(1, 2, 3), F.lit(None)).otherwise(200).alias("status_code"),
        F.when(kind == 0, "http")
        .when(kind == 1, "request")
        .when(kind == 2, "other")
        .when(kind == 3, "outside")
        .alias("error_kind"),
        F.when(kind == 0, "404 Not Found")
        .when(kind == 1, "timed out")
        .when(kind == 2, "broken")
        .when(kind == 3, "lost")
        .alias("error"),
        (kind / 10).alias("elapsed_time"),
    )


def status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Work state of the documents: labelled ones are scraped, good ones cleaned, toxic ones
    analysed."""
    labels = table(spark, sf_dir, "labels")
    return table(spark, sf_dir, "documents").select("doc_id").join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("news_id"),
        F.lit(True).alias("raw_data"),
        F.col("quality").isNotNull().alias("scraped_data"),
        F.coalesce(F.col("quality") == 1, F.lit(False)).alias("cleaned_data"),
        F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("llm_data"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars by event type."""
    ticks = table(spark, sf_dir, "events").withColumn(
        "ticker", F.concat("event_type", F.lit("-USD"))
    )
    return daily_bars(ticks, "ticker", "ts", "value", "event_id")


def response_item(doc: DataFrame) -> DataFrame:
    """One JSON answer per document, ``news_id, item``; the kind of fault follows the id."""
    kind = F.col("doc_id") % 10
    share = F.col("n_chars") % 100

    def decimal(number):
        return F.concat(F.lit("0."), F.lpad(number.cast("string"), 2, "0"))

    values = {name: F.lit("0.5") for name in V.REQUIRED_SCORES}
    values["positive"] = decimal(share)
    values["negative"] = decimal(F.lit(99) - share)
    values["neutral"] = F.when(kind == 5, "0.5").otherwise("0.01")
    values["confidence_score"] = F.when(kind == 1, "1.2").otherwise("0.75")
    quote = F.when(kind == 3, "").otherwise('"')
    scores = [
        F.concat(F.lit(f'"{name}": '), quote, value, quote)
        for name, value in values.items()
        if name != "virality_score"
    ]
    fields = [
        F.concat(F.lit('"news_id": "'), F.col("doc_id"), F.lit('"')),
        F.when(kind == 0, '"emotion_category": "Angry"').otherwise('"emotion_category": "Fearful"'),
        F.when(kind == 6, '"event_category": ["Market", "Gossip"]').otherwise(
            '"event_category": ["Market", "DeFi"]'
        ),
        F.lit('"price_direction_category": "Upward"'),
        F.lit('"timeframe_category": "long-term"'),
        *scores,
        F.when(kind != 2, '"virality_score": 0.5'),
        F.concat(F.lit('"key_topics": ["'), "lang", F.lit('", "'), "source", F.lit('"]')),
        F.concat(F.lit('"free_text_summary": "About '), F.col("doc_id"), F.lit('"')),
        F.when(kind == 4, '"historical_analogy": null').otherwise('"historical_analogy": "None"'),
    ]
    return doc.select(
        F.col("doc_id").alias("news_id"),
        F.concat(F.lit("{"), F.concat_ws(", ", *fields), F.lit("}")).alias("item"),
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Answers in batches of 20 ids; every seventh batch is cut off in the middle."""
    items = response_item(table(spark, sf_dir, "documents"))
    batch = F.floor(F.col("news_id") / 20)
    ordered = F.sort_array(F.collect_list(F.struct("news_id", "item")))
    text = F.concat(
        F.lit("["), F.array_join(F.transform(ordered, lambda e: e["item"]), ", "), F.lit("]")
    )
    return (
        items.groupBy(batch.alias("batch_id"))
        .agg(text.alias("text"))
        .select(
            "batch_id",
            F.when(F.col("batch_id") % 7 == 3, F.expr("left(text, length(text) - 20)"))
            .otherwise(F.col("text"))
            .alias("response_json"),
        )
    )
