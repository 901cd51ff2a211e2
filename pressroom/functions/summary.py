"""Extractive summary within a token budget, computed inside each article's row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pressroom import fixed_values as V
from pressroom.functions import sentences as S
from pressroom.functions.similarity import dense_row_scores, tfidf_row_scores
from pressroom.functions.text import token_count

# Scores are compared at this many decimals, so that ties do not hang on the order of additions.
SCORE_DIGITS = 9


def with_centrality(
    df: DataFrame,
    n_words: str,
    out: str = "centrality",
    *,
    terms: str | None = None,
    vectors: str | None = None,
) -> DataFrame:
    """Add the centrality of each sentence, from its terms or from supplied vectors.

    ``n_words`` is the array of word counts per sentence.
    """
    rows = (
        dense_row_scores(F.col(vectors), F.col("_weights"))
        if vectors
        else tfidf_row_scores(F.col(terms), F.col("_weights"))
    )
    return (
        df.withColumn("_q90", S.array_quantile(F.col(n_words), V.LENGTH_QUANTILE))
        .withColumn("_weights", S.length_weights(F.col(n_words), F.col("_q90")))
        .withColumn("_rows", rows)
        .withColumns({"_median": F.col("_rows.median"), "_local": F.col("_rows.local")})
        .withColumn(
            out,
            F.zip_with(
                S.scaled(F.col("_median")),
                S.scaled(F.col("_local")),
                lambda wide, near: wide * V.GLOBAL_SHARE + near * V.LOCAL_SHARE,
            ),
        )
        .drop("_q90", "_weights", "_rows", "_median", "_local")
    )


def with_sentence_scores(df: DataFrame, centrality: str, out: str) -> DataFrame:
    """Add 0.75 centrality + 0.20 intro + 0.05 conclusion for each sentence."""
    n = F.size(centrality)
    numbered = F.transform(
        F.arrays_zip(F.col(centrality).alias("value"), F.array_repeat(n, n).alias("n")),
        lambda item, index: F.struct(
            item["value"].alias("value"), item["n"].alias("n"), index.alias("idx")
        ),
    )

    def score(item):
        intro, conclusion = S.position_scores(item["n"], item["idx"])
        return F.round(
            item["value"] * V.CENTRALITY_SHARE
            + intro * V.INTRO_SHARE
            + conclusion * V.CONCLUSION_SHARE,
            SCORE_DIGITS,
        )

    return df.withColumn(out, F.transform(numbered, score))


def with_ranking(df: DataFrame, score: str, tokens: str, sentences: str, out: str) -> DataFrame:
    """Add ``array<struct<score, idx, tokens, sentence>>``, best first; ties: later first."""
    paired = F.transform(
        F.arrays_zip(
            F.col(score).alias("score"),
            F.col(tokens).alias("tokens"),
            F.col(sentences).alias("sentence"),
        ),
        lambda item, index: F.struct(
            item["score"].alias("score"),
            index.alias("idx"),
            item["tokens"].alias("tokens"),
            item["sentence"].alias("sentence"),
        ),
    )
    return df.withColumn(out, F.sort_array(paired, asc=False))


def with_budget(
    df: DataFrame, ranking: str, out: str, max_tokens: int, compat: bool = False
) -> DataFrame:
    """Add how many sentences of the ranking fit before the running token sum passes the budget.

    With ``compat`` the last-ranked sentence is left out even when the budget is never passed.
    """
    state = F.struct(F.lit(0).alias("total"), F.lit(0).alias("kept"))
    kept = F.aggregate(
        ranking,
        state,
        lambda acc, item: F.struct(
            (acc["total"] + item["tokens"]).alias("total"),
            F.when(acc["total"] + item["tokens"] <= max_tokens, acc["kept"] + 1)
            .otherwise(acc["kept"])
            .alias("kept"),
        ),
        lambda acc: acc["kept"],
    )
    if compat:
        kept = F.least(kept, F.size(ranking) - 1)
    return df.withColumn(out, kept)


def with_summary(
    df: DataFrame,
    text: str,
    out: str,
    *,
    max_tokens: int = V.MAX_ARTICLE_TOKENS,
    embed=None,
    token_counter=token_count,
    sentence_counter=None,
    sentences: str | None = None,
    compat: bool = False,
) -> DataFrame:
    """Add the text cut down to its most central sentences, in their own order.

    Texts below ``max_tokens`` pass unchanged; long texts of fewer than three sentences, or that
    cannot be cut to size, give null. ``embed`` may turn the sentence array column into an array
    of vectors; by default the words of the sentences are compared. A ``token_counter`` that is
    a Python function needs a ``sentence_counter`` beside it, from the sentence array to the array
    of counts. ``sentences`` names a column of sentences found before, in place of cutting after
    every mark. The work arrays of short texts are null, so they cost next to nothing.
    """
    is_long = F.col("_tokens") >= max_tokens
    long_text = F.when(is_long, F.col(text))
    enough = F.size("_all") >= V.LOCAL_WINDOW
    df = (
        df.withColumn("_tokens", token_counter(F.col(text)))
        .withColumn("_all", F.when(is_long, F.col(sentences)) if sentences else S.split_sentences(long_text))
        .withColumn("_sentences", F.when(enough, F.col("_all")))
        .withColumns(
            {
                "_n_words": S.sentence_words(F.col("_sentences")),
                "_n_tokens": sentence_counter(F.col("_sentences"))
                if sentence_counter
                else S.sentence_tokens(F.col("_sentences"), token_counter),
                "_features": embed(F.col("_sentences"))
                if embed
                else S.sentence_terms(F.col("_sentences")),
            }
        )
    )
    source = {"vectors": "_features"} if embed else {"terms": "_features"}
    df = with_centrality(df, "_n_words", "_centrality", **source)
    df = with_sentence_scores(df, "_centrality", "_scores")
    df = with_ranking(df, "_scores", "_n_tokens", "_sentences", "_ranking")
    df = with_budget(df, "_ranking", "_kept", max_tokens, compat)
    chosen = F.array_sort(
        F.transform(
            F.slice("_ranking", F.lit(1), F.col("_kept")),
            lambda item: F.struct(item["idx"], item["sentence"].alias("sentence")),
        )
    )
    summary = F.array_join(F.transform(chosen, lambda item: item["sentence"]), " ")
    # An empty summary counts as none, unless the original behaviour is asked for.
    fits = token_counter(F.col("_summary")) <= V.SUMMARY_TOLERANCE * max_tokens
    if not compat:
        fits = fits & (F.col("_summary") != "")
    return (
        df.withColumn("_summary", summary)
        .withColumn(
            out, F.when(is_long, F.when(fits, F.col("_summary"))).otherwise(F.col(text))
        )
        .drop(
            "_tokens", "_all", "_sentences", "_n_words", "_n_tokens", "_features",
            "_centrality", "_scores", "_ranking", "_kept", "_summary",
        )
    )
