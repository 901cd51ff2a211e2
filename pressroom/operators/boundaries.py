"""Sentence boundaries learned from the corpus, without labels.

After Kiss and Strunk (2006): a token is an abbreviation if its period belongs to it more often than
chance would have it; words that follow sure sentence ends are sentence starters; words that follow
an abbreviation, an initial or a number more often than chance are collocations with it. All counts
are grouped aggregations over all documents, added up before the shuffle; what is learned are three
tables, joined to the boundaries in question, never collected. Tokens are trimmed and compared
without regular expressions: there are some hundred million in a gigabyte.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from pressroom.functions.arrays import explode_rows
from pressroom.session import store

#: The thresholds of the published method.
ABBREVIATION_SCORE = 0.3
STARTER_SCORE = 30.0
COLLOCATION_SCORE = 7.88
#: A token above this many characters is no type: its length factor alone rules it out.
LONGEST = 64

SPACE = r"[ \t\r\n\f]"
_MARK = "\x01"
_SURE = 1e-9


@dataclass
class Boundaries:
    """What a corpus says of periods: ``abbreviations(type, score)``, ``starters(type, score)`` and
    ``collocations(type, next_type, score)``."""

    abbreviations: DataFrame
    starters: DataFrame
    collocations: DataFrame


def shortened(token: Column) -> Column:
    """The token; empty for very long ones."""
    return F.when(F.length(token) <= LONGEST, token).otherwise("")


def core(token: Column) -> Column:
    """A token without quotes and brackets around it; empty for very long ones."""
    return F.rtrim(F.ltrim(shortened(token), F.lit("\"'([{")), F.lit("\"')]}"))


def token_type(bare: Column) -> Column:
    """Lower-case form without marks at the end."""
    return F.lower(F.rtrim(bare, F.lit(".!?,;:")))


def ends_in_period(bare: Column) -> Column:
    """One period at the end; several are an ellipsis."""
    return bare.endswith(".") & ~bare.endswith("..")


def _log(p: Column) -> Column:
    return F.ln(F.greatest(F.least(p, F.lit(1 - _SURE)), F.lit(_SURE)))


def _binomial(hits: Column, tries: Column, p: Column) -> Column:
    """Log likelihood of ``hits`` among ``tries`` at probability ``p``."""
    return hits * _log(p) + (tries - hits) * _log(1 - p)


def abbreviation_score(n: Column, n_period: Column, total: Column, periods: Column, kind: Column) -> Column:
    """Likelihood ratio of a period that belongs to the word, for short words and inner periods."""
    ratio = -2 * (_binomial(n_period, n, periods / total) - _binomial(n_period, n, F.lit(0.99)))
    letters = F.length(F.replace(kind, F.lit("."), F.lit("")))
    inner = F.length(kind) - letters
    return ratio * F.exp(-letters) * (inner + 1) * F.pow(letters, -(n - n_period))


def association(a: Column, b: Column, both: Column, total: Column) -> Column:
    """Likelihood ratio of ``b`` being more frequent after ``a`` than elsewhere."""
    p, p1, p2 = b / total, both / a, (b - both) / (total - a)
    null = _binomial(both, a, p) + _binomial(b - both, total - a, p)
    return -2 * (null - _binomial(both, a, p1) - _binomial(b - both, total - a, p2))


def spaced(text: Column) -> Column:
    """A text with spaces for all white space, of the same length."""
    return F.regexp_replace(text, r"[\t\r\n\f]", " ")


def pieces(trimmed: Column) -> Column:
    """A text cut after every token that ends in a full stop, question or exclamation mark."""
    marked = F.regexp_replace(trimmed, rf"([.!?][\"')\]}}]*)({SPACE}+)", "$1" + _MARK + "$2")
    return F.split(marked, _MARK)


def candidates(docs: DataFrame, key: list[str], text: str) -> DataFrame:
    """``(key, pos, type, period, sure_kind, next_type, next_upper, next_lower)`` per possible boundary.

    ``sure_kind`` is ``initial`` or ``number`` for tokens that need no list.
    """
    # Only spaces at the ends are trimmed: other white space there still makes a boundary.
    cut = docs.select(*key, pieces(spaced(F.trim(F.col(text)))).alias("_pieces"))
    inner = F.zip_with(
        F.slice("_pieces", F.lit(1), F.greatest(F.size("_pieces") - 1, F.lit(0))),
        F.slice("_pieces", F.lit(2), F.greatest(F.size("_pieces") - 1, F.lit(0))),
        lambda a, b: F.struct(a.alias("before"), b.alias("after")),
    )
    rows = explode_rows(cut.select(*key, inner.alias("_inner")), key, "_inner", "pos", "_pair")
    last = F.substring_index("_pair.before", " ", -1)
    first = F.substring_index(F.ltrim("_pair.after"), " ", 1)
    rows = rows.select(*key, "pos", core(last).alias("_last"), core(first).alias("_first"))
    last, first = F.col("_last"), F.col("_first")
    period = ends_in_period(last)
    initial = period & (F.length(last) == 2) & last.rlike(r"^\p{L}\.\z")
    kind = F.when(initial, "initial").when(period & last.rlike(r"^[0-9][0-9.,]*\.\z"), "number")
    return rows.select(
        *key, "pos", token_type(last).alias("type"), period.alias("period"), kind.alias("sure_kind"),
        token_type(first).alias("next_type"), first.rlike(r"^\p{Lu}").alias("next_upper"), first.rlike(r"^\p{Ll}").alias("next_lower"),
    )


def learn(docs: DataFrame, text: str = "text") -> Boundaries:
    """Learn from all documents; null and empty texts say nothing, and no texts give empty tables."""
    # Outer for the reason given at explode_rows. Every distinct token is trimmed once.
    tokens = docs.select(F.explode_outer(F.split(F.col(text), SPACE + "+")).alias("token")).filter("token != ''")
    tokens = tokens.groupBy(shortened(F.col("token")).alias("token")).agg(F.count(F.lit(1)).alias("n"))
    bare = tokens.select(core(F.col("token")).alias("bare"), "n")
    seen = bare.select(token_type(F.col("bare")).alias("type"), ends_in_period(F.col("bare")).alias("period"), "n")
    types = seen.groupBy("type").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("period"), F.col("n"))), F.lit(0)).alias("n_period")
    )
    types = store(types, "token-types")
    sums = types.agg(F.sum("n").alias("total"), F.sum("n_period").alias("periods"))
    total, periods = (sums.select(c).scalar() for c in ("total", "periods"))

    words = types.filter(F.col("type").rlike(r"\p{L}"))
    scored = words.filter("n_period > 0").withColumn(
        "score", abbreviation_score(F.col("n"), F.col("n_period"), total, periods, F.col("type"))
    )
    abbreviations = store(scored.filter(F.col("score") >= ABBREVIATION_SCORE).select("type", "score"), "abbreviations")

    # After sure sentence ends only the next word counts, so that most pairs are added up at once.
    rows = candidates(docs, [], text)
    known = abbreviations.select("type", F.lit("abbreviation").alias("learned"))
    kind = F.when(F.col("period"), F.coalesce("sure_kind", "learned"))
    pairs = rows.join(known, "type", "left").select("type", kind.alias("kind"), "next_type")
    pairs = pairs.withColumn("type", F.when(F.col("kind").isNotNull(), F.col("type")))
    pairs = store(pairs.groupBy("type", "kind", "next_type").agg(F.count(F.lit(1)).alias("both")), "boundary-pairs")

    after = pairs.filter("kind IS NULL").groupBy("next_type").agg(F.sum("both").alias("both"))
    ends = pairs.filter("kind IS NULL").agg(F.sum("both").alias("ends")).scalar()
    starting = after.join(words.select(F.col("type").alias("next_type"), "n"), "next_type")
    starting = starting.withColumn("score", association(ends, F.col("n"), F.col("both"), total))
    often = F.col("both") / ends > F.col("n") / total
    starters = starting.filter((F.col("score") >= STARTER_SCORE) & often).select(F.col("next_type").alias("type"), "score")
    starters = store(starters, "starters")

    bound = pairs.filter("kind IS NOT NULL").groupBy("type", "next_type").agg(F.sum("both").alias("both")).filter("both > 1")
    bound = bound.join(types.select("type", F.col("n").alias("n_type")), "type")
    bound = bound.join(words.select(F.col("type").alias("next_type"), F.col("n").alias("n_next")), "next_type")
    bound = bound.join(starters.select(F.col("type").alias("next_type")), "next_type", "left_anti")
    bound = bound.withColumn("score", association(F.col("n_type"), F.col("n_next"), F.col("both"), total))
    often = F.col("both") / F.col("n_type") > F.col("n_next") / total
    collocations = bound.filter((F.col("score") >= COLLOCATION_SCORE) & often).select("type", "next_type", "score")
    return Boundaries(abbreviations, starters, store(collocations, "collocations"))


def decided(rows: DataFrame, learned: Boundaries) -> DataFrame:
    """``candidates`` with ``joined``: whether the sentence goes on after the period.

    It goes on after an abbreviation or initial, unless a sentence starter in upper case follows; and
    after a number before a lower-case letter; and always inside a collocation.
    """
    known = learned.abbreviations.select("type", F.lit("abbreviation").alias("_learned"))
    starting = learned.starters.select(F.col("type").alias("next_type"), F.lit(True).alias("_starts"))
    bound = learned.collocations.select("type", "next_type", F.lit(True).alias("_bound"))
    rows = rows.join(known, "type", "left").withColumn("_kind", F.when(F.col("period"), F.coalesce("sure_kind", "_learned")))
    rows = rows.join(starting, "next_type", "left").join(bound, ["type", "next_type"], "left")
    starts = F.coalesce("_starts", F.lit(False)) & F.col("next_upper")
    joined = F.when(F.col("_kind").isNull(), False).when(F.coalesce("_bound", F.lit(False)), True)
    joined = joined.when(F.col("_kind") == "number", F.col("next_lower")).otherwise(~starts)
    return rows.withColumn("joined", joined).drop("_learned", "_kind", "_starts", "_bound")


def with_learned_sentences(
    docs: DataFrame, key: str, learned: Boundaries, text: str = "text", out: str = "sentences"
) -> DataFrame:
    """Add the sentences of each text as ``array<string>``, without white space around them.

    ``key`` is unique and not null. A null text has null, an empty one no sentences. Only tokens at
    possible boundaries are shuffled; the text meets its decisions once.
    """
    rows = decided(candidates(docs, [key], text), learned)
    # Position and decision in one number, which sorts by position.
    coded = F.sort_array(F.collect_list(F.col("pos") * 2 + F.col("joined").cast("int")))
    flags = rows.groupBy(key).agg(F.transform(coded, lambda c: c % 2 == 1).alias("_joined"))
    cut = docs.withColumn("_pieces", pieces(F.trim(F.col(text)))).join(flags, key, "left")
    last = F.array(F.lit(False))
    aligned = F.concat(F.coalesce("_joined", F.array().cast("array<boolean>")), last)
    whole = F.array_join(
        F.zip_with("_pieces", aligned, lambda p, on: F.when(on, p).otherwise(F.concat(p, F.lit(_MARK)))), ""
    )
    trimmed = F.transform(F.split(whole, _MARK), lambda s: F.btrim(s, F.lit(" \t\r\n\f")))
    return cut.withColumn(out, F.filter(trimmed, lambda s: s != "")).drop("_pieces", "_joined")
