"""Main-text extraction from HTML as column expressions; one row in, one row out.

Markup is read by ``markup.page_parts``; which blocks stay is decided here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pressroom import fixed_values as V
from pressroom.functions.markup import page_parts


def _plain(text: Column) -> Column:
    """Markup-free block: entities decoded, whitespace collapsed."""
    return F.trim(F.regexp_replace(text, V.WHITESPACE, " "))


def with_blocks(df: DataFrame, html: str = "html", out: str = "blocks") -> DataFrame:
    """Add the kept text blocks of a page, in order, as ``array<string>``, and ``_paragraphs``.

    Comments, scripts, navigation, tables, forms and boxes named like advertisements go, each up to
    the closer that matches it, whatever is nested inside; the rest of the article element (or the
    whole page) is cut at block tags. A block stays when it has a word and at most half of its
    characters are link text. An opener or comment that is never closed takes no text along.
    """

    def keep(block: Column) -> Column:
        return block["text"].rlike(V.WORD) & (block["linked"] * 2 <= F.length(block["text"]))

    return (
        df.withColumn("_parts", page_parts(F.col(html)))
        .withColumn("_pieces", F.filter("_parts.blocks", keep))
        .withColumn(out, F.transform("_pieces", lambda block: _plain(block["text"])))
        .withColumn("_paragraphs", F.col("_parts.paragraphs"))
        .drop("_parts", "_pieces")
    )


def with_fallback(df: DataFrame, blocks: str = "blocks", out: str = "full_text") -> DataFrame:
    """Join the kept blocks by line; when none is left, take all paragraphs of the page."""
    joined = F.array_join(F.filter(F.transform("_paragraphs", _plain), lambda p: p != ""), "\n")
    text = F.when(F.size(blocks) > 0, F.array_join(blocks, "\n")).otherwise(joined)
    return df.withColumn(out, text).withColumn(out, F.nullif(F.col(out), F.lit(""))).drop("_paragraphs")


def with_text(df: DataFrame, html: str = "html", out: str = "full_text") -> DataFrame:
    """Add the article text of a page, or null when there is none."""
    return with_fallback(with_blocks(df, html, "_blocks"), "_blocks", out).drop("_blocks")


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)


def with_dense_text(df: DataFrame, html: str = "html", out: str = "full_text") -> DataFrame:
    """Add the text of the densest run of blocks, for pages that mark no article.

    A block is worth its words, less ``V.BLOCK_COST`` and ``V.TAG_COST`` for each tag inside it; words
    count against it where most of it is links. Worths are smoothed over both neighbours, and the run
    with the greatest sum is found by running sums in one fold; of equal ones the first end and the
    last start. Pages without such a run fall back as ``with_fallback`` does.
    """
    linked = F.transform("_words", lambda b: b["linked"] * 2 > F.length(b["text"]))
    words = F.transform("_words", lambda b: F.regexp_count(b["text"], F.lit(V.WORD)))
    cost = F.transform("_words", lambda b: V.BLOCK_COST + V.TAG_COST * b["tags"])
    worth = F.zip_with(F.zip_with(words, linked, lambda n, bad: F.when(bad, -n).otherwise(n)), cost, lambda n, c: n - c)
    n, zero = F.size("_worth"), F.array(F.lit(0))
    before = F.concat(zero, F.slice("_worth", F.lit(1), F.greatest(n - 1, F.lit(0))))
    after = F.concat(F.slice("_worth", F.lit(2), F.greatest(n - 1, F.lit(0))), zero)
    near = F.zip_with(before, after, lambda a, b: a + b)
    smooth = F.zip_with(F.slice(near, F.lit(1), n), "_worth", lambda a, b: F.coalesce(a, F.lit(0)) + 2 * b)

    def state(now, start, best, first, last, at):
        return F.struct(
            now.cast("long").alias("now"), start.cast("int").alias("start"), best.cast("long").alias("best"),
            first.cast("int").alias("first"), last.cast("int").alias("last"), at.cast("int").alias("at"),
        )

    def step(run, value):
        fresh = run["now"] <= 0
        now = F.when(fresh, value).otherwise(run["now"] + value)
        start = F.when(fresh, run["at"]).otherwise(run["start"])
        better = now > run["best"]
        return state(
            now, start, F.greatest(now, run["best"]), F.when(better, start).otherwise(run["first"]),
            F.when(better, run["at"]).otherwise(run["last"]), run["at"] + 1,
        )

    def keep(block: Column) -> Column:
        return block["linked"] * 2 <= F.length(block["text"])

    none = F.lit(0)
    found = F.aggregate("_smooth", state(none, none, none, none, F.lit(-1), none), step)
    run = F.slice("_words", F.col("_run.first") + 1, F.col("_run.last") - F.col("_run.first") + 1)
    dense = F.array_join(F.transform(F.filter(run, keep), lambda b: _plain(b["text"])), "\n")
    cut = (
        df.withColumn("_parts", page_parts(F.col(html)))
        .withColumn("_words", F.filter("_parts.blocks", lambda b: b["text"].rlike(V.WORD)))
        .withColumn("_worth", worth)
        .withColumn("_smooth", smooth)
        .withColumn("_run", found)
        .withColumn("_dense", F.when(F.col("_run.best") > 0, dense))
        .withColumn("_blocks", F.transform(F.filter("_words", keep), lambda b: _plain(b["text"])))
        .withColumn("_paragraphs", F.col("_parts.paragraphs"))
    )
    whole = with_fallback(cut, "_blocks", out)
    text = F.coalesce(F.nullif(F.col("_dense"), F.lit("")), F.col(out))
    return whole.withColumn(out, text).drop("_parts", "_words", "_worth", "_smooth", "_run", "_dense", "_blocks")
