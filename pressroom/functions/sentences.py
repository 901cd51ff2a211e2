"""Sentences of a document as arrays in its own row: nothing here needs a shuffle.

A lambda must not use a column from outside: the optimizer may inline that column's expression
into the lambda, to be computed anew for every element. Per-row values are repeated into an
array of their own and zipped in instead.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pressroom import fixed_values as V
from pressroom.functions.text import token_count

_MARK = "\x01"


def split_sentences(text: Column) -> Column:
    """Cut after ``.``, ``!`` or ``?`` followed by white space."""
    marked = F.regexp_replace(F.trim(text), V.SENTENCE_END, "$1" + _MARK)
    return F.filter(F.split(marked, _MARK), lambda sentence: sentence != "")


def space_words(text: Column) -> Column:
    """Number of pieces between white space."""
    return F.regexp_count(text, F.lit(r"\S+"))


def sentence_words(sentences: Column) -> Column:
    return F.transform(sentences, space_words)


def sentence_tokens(sentences: Column, token_counter=token_count) -> Column:
    return F.transform(sentences, token_counter)


def array_quantile(values: Column, q: float) -> Column:
    """Exact quantile of an array, linear between ranks; ``values`` should be a plain column."""
    ordered = F.array_sort(values)
    position = (F.size(values) - 1) * F.lit(q)
    low = F.floor(position).cast("int")
    high = F.ceil(position).cast("int")
    below = F.get(ordered, low).cast("double")
    above = F.get(ordered, high).cast("double")
    return below + (above - below) * (position - low)


def length_weights(n_words: Column, quantile: Column) -> Column:
    """``min(words / quantile, 1)`` per sentence."""
    return F.zip_with(
        n_words,
        F.array_repeat(quantile, F.size(n_words)),
        lambda n, q: F.least(n / q, F.lit(1.0)),
    )


def position_scores(n: Column, index: Column) -> tuple[Column, Column]:
    """Intro and conclusion score of sentence ``index`` (from 0) among ``n``."""
    intro, conclusion = F.lit(0.0), F.lit(0.0)
    for place, weight in reversed(list(enumerate(V.INTRO_WEIGHTS))):
        intro = F.when((index == place) & (n > len(V.INTRO_WEIGHTS)), weight).otherwise(intro)
    enough = len(V.INTRO_WEIGHTS) + len(V.CONCLUSION_WEIGHTS)
    for place, weight in enumerate(reversed(V.CONCLUSION_WEIGHTS)):
        conclusion = F.when((index == n - 1 - place) & (n >= enough), weight).otherwise(conclusion)
    return intro, conclusion


def sentence_terms(sentences: Column) -> Column:
    """Lower-case words of each sentence without stop words."""
    stop = [word for word in V.STOP_WORDS if "'" not in word]
    return F.transform(
        sentences,
        lambda sentence: F.filter(
            F.regexp_extract_all(F.lower(sentence), F.lit(V.WORD), F.lit(0)),
            lambda word: ~word.isin(stop),
        ),
    )


def scaled(values: Column) -> Column:
    """Min-max scaling within the array; ``values`` should be a plain column."""
    low, high = F.array_min(values), F.array_max(values)
    bounds = F.struct(low.alias("low"), (high - low + V.SCALE_EPSILON).alias("span"))
    return F.zip_with(
        values,
        F.array_repeat(bounds, F.size(values)),
        lambda v, b: (v - b["low"]) / b["span"],
    )
