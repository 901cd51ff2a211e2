"""Text normalisation, measuring, spam scoring and curation as column expressions."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, DataFrame, functions as F

from pressroom import fixed_values as V
from pressroom.functions.scripts import repaired, spelled


def emoji_class() -> str:
    """The inside of a regex character class covering every single-character emoji."""
    return "".join(
        "-".join(rf"\x{{{code}}}" for code in entry.split("-")) for entry in V.EMOJI_CODE_POINTS
    )


NON_ASCII = r"[^\x00-\x7F]"
CONTROL = r"\x1B\[[0-9;]*[A-Za-z]|[\x00-\x08\x0B\x0E-\x1F\x7F-\x84\x86-\x9F]"
ASCII_RUN = r"[\x00-\x7F]+"
# Keeps an emoji, with the joiners and variation marks after it, and letters and digits of any script
# as group 1; anything else left over from transliteration falls outside the group. No group repeats,
# so that a long run needs no stack.
EMOJI_OR_OTHER = rf"([{emoji_class()}][\x{{FE0F}}\x{{200D}}]*|[^\x00-\x7F\P{{L}}]|[^\x00-\x7F\P{{M}}]|[^\x00-\x7F\P{{N}}])|{NON_ASCII}"
# The look-ahead turns down ASCII at once; the emoji class is a long list of ranges.
KEEP_EMOJI = rf"(?={NON_ASCII})(?:{EMOJI_OR_OTHER})"

# What UTF-8 looks like where it was read as Windows-1252 or Latin-1: a lead, then other bytes.
GARBLED = r"[\xC2-\xF4][\x80-\xBF\x{0152}\x{0153}\x{0160}\x{0161}\x{0178}\x{017D}\x{017E}\x{0192}\x{02C6}\x{02DC}\x{2013}-\x{203A}\x{20AC}\x{2122}]"
# Letters beyond Latin that may have a Latin spelling, compatibility forms, and marks apart from their letter.
UNSPELLED = r"[\x{0300}-\x{052F}\x{1100}-\x{11FF}\x{1C80}-\x{1C8F}\x{1D00}-\x{1DBF}\x{1F00}-\x{1FFF}\x{2000}-\x{2BFF}\x{3000}-\x{33FF}\x{AC00}-\x{D7AF}\x{FB00}-\x{FFEF}\x{1D400}-\x{1D7FF}\x{1F100}-\x{1F1FF}]"


@cache
def transliteration() -> tuple[str, str, dict[str, str]]:
    """Latin and punctuation characters to ASCII.

    Letters follow from their compatibility decomposition with the marks dropped. Returns the
    two sides of a one-to-one mapping, and a mapping for characters that need several letters.
    """
    single = {
        "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ı": "i",
        "ħ": "h", "Ħ": "H", "ŧ": "t", "Ŧ": "T", "ŋ": "n", "Ŋ": "N", "‘": "'", "’": "'", "‚": "'",
        "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "«": '"', "»": '"', "‹": "'", "›": "'",
        "‐": "-", "‑": "-", "‒": "-", "–": "-", "―": "-", "•": "*", "·": "*", "×": "x", "÷": "/",
        "¡": "!", "¿": "?", "°": "d", "±": "+", "¦": "|", "´": "'", "⁄": "/", "−": "-", "′": "'",
        "″": '"', "\u2028": "\n", "\u2029": "\n", "\x85": "\n",
    }
    several = {
        "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th",
        "—": "--", "€": "EUR", "£": "GBP", "¥": "JPY", "§": "SS",
    }
    blocks = [(0xA0, 0x24F), (0x1E00, 0x1EFF), (0x2000, 0x206F), (0x2100, 0x218F), (0xFB00, 0xFB06)]
    emoji = {
        chr(code)
        for entry in V.EMOJI_CODE_POINTS
        for code in range(int(entry.split("-")[0], 16), int(entry.split("-")[-1], 16) + 1)
    }
    for first, last in blocks:
        for code in range(first, last + 1):
            char = chr(code)
            if char in single or char in several or char in emoji:
                continue
            plain = unicodedata.normalize("NFKD", char)
            plain = "".join(single.get(part, part) for part in plain)
            plain = "".join(part for part in plain if ord(part) < 128)
            if len(plain) == 1:
                single[char] = plain
            # Roman numerals and the like are rare and stay out of the long replacement chain.
            elif len(plain) > 1 and (code < 0x250 or 0xFB00 <= code or char == "…"):
                several[char] = plain
    return "".join(single), "".join(single.values()), several


def is_ascii(text: Column) -> Column:
    return F.length(text) == F.octet_length(text)


def fix_unicode(text: Column) -> Column:
    """Undo UTF-8 that was read as Windows-1252 or Latin-1, run by run; drop control characters.

    ``text`` should be a plain column: it is used several times.
    """
    fixed = F.coalesce(repaired(F.when(text.rlike(GARBLED), text)), text)
    return F.regexp_replace(fixed, CONTROL, "")


def latin_to_ascii(text: Column) -> Column:
    """Latin letters and punctuation to ASCII. ``text`` should be a plain column."""
    source, target, several = transliteration()
    spelled = text
    for char, plain in several.items():
        spelled = F.replace(spelled, F.lit(char), F.lit(plain))
    some = text.rlike("[" + "".join(several) + "]")
    return F.translate(F.when(some, spelled).otherwise(text), source, target)


def drop_non_ascii(text: Column) -> Column:
    """ASCII characters, emoji and letters and digits of other scripts stay."""
    return F.regexp_replace(text, KEEP_EMOJI, "$1")


def normalize_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, V.WHITESPACE, " "))


def replace_urls(text: Column, label: str = "<URL>") -> Column:
    return F.regexp_replace(text, V.URL, label)


def replace_phones(text: Column, label: str = "<PHONE>") -> Column:
    return F.regexp_replace(text, V.PHONE, label)


def with_clean_text(
    df: DataFrame,
    text: str,
    out: str,
    *,
    no_emails: bool = False,
    no_numbers: bool = False,
    no_punct: bool = False,
) -> DataFrame:
    """Add the normalised text; null stays null.

    Every step is a column of its own that the next one tests cheaply before any regex runs:
    plain ASCII rows skip the Unicode steps, rows without a link the URL step, and so on.
    """

    def step(frame: DataFrame, needed, change) -> DataFrame:
        now = F.col("_text")
        return frame.withColumn("_text", F.when(needed(now), change(now)).otherwise(now))

    raw = F.col(text)
    df = df.withColumn("_text", fix_unicode(raw))
    df = step(df, lambda t: ~is_ascii(t), latin_to_ascii)
    now = F.col("_text")
    other = F.when(~is_ascii(now), F.when(now.rlike(UNSPELLED), now))
    df = df.withColumn("_spelled", spelled(other)).withColumn("_text", F.coalesce("_spelled", "_text")).drop("_spelled")
    df = step(df, lambda t: ~is_ascii(t), drop_non_ascii)
    df = step(df, lambda t: t.rlike("://|[wW]{3}"), replace_urls)
    if no_emails:
        df = step(
            df, lambda t: t.contains("@"), lambda t: F.regexp_replace(t, V.EMAIL, "<EMAIL>")
        )
    df = step(df, lambda t: t.rlike(r"[0-9]{3}[ .-]?[0-9]{4}"), replace_phones)
    result = F.col("_text")
    if no_numbers:
        result = F.regexp_replace(result, V.NUMBER, "<NUMBER>")
    if no_punct:
        result = F.translate(result, V.ASCII_PUNCTUATION, "")
    # One row out of an array of one: the optimizer does not carry these steps, which it would
    # repeat for every use beside Arrow functions, over into what is computed from the text.
    return df.withColumn(out, F.explode_outer(F.array(normalize_whitespace(result)))).drop("_text")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(V.WORD))


def token_count(text: Column) -> Column:
    """Estimated number of model tokens: letters by fours, digits by threes, other marks singly."""
    return F.regexp_count(text, F.lit(V.TOKEN))


def measure(df: DataFrame, *columns: str, token_counter=token_count) -> DataFrame:
    """Add ``<column>_word_count`` and ``<column>_token_count`` for each text column."""
    counts = {}
    for name in columns:
        counts[f"{name}_word_count"] = word_count(F.col(name))
        counts[f"{name}_token_count"] = token_counter(F.col(name))
    return df.withColumns(counts)


def plain_words(text: Column) -> Column:
    """Lower-case words after punctuation other than ``!`` is deleted."""
    bare = F.translate(F.lower(text), V.ASCII_PUNCTUATION.replace("!", ""), "")
    return F.regexp_extract_all(bare, F.lit(V.WORD), F.lit(0))


def with_spam_score(df: DataFrame, text: str, out: str = "spam_score") -> DataFrame:
    """Add the spam score in [0, 1] of a text column; null text gives null.

    The word array is a column of its own, so that it is built once per row.
    """
    words = F.col("_words")
    total = F.greatest(F.size("_words"), F.lit(1))

    def share(count: Column, weight: float) -> Column:
        return F.least(count / (total * F.lit(weight)), F.lit(1.0))

    # Emoji are looked for among the non-ASCII characters only, and not at all in ASCII rows.
    other = F.regexp_replace(F.col(text), ASCII_RUN, "")
    emoji = F.when(F.length(text) == F.octet_length(text), 0).otherwise(
        F.regexp_count(other, F.lit(f"[{emoji_class()}]"))
    )
    promo = F.size(F.filter(words, lambda word: word.isin(V.PROMO_WORDS)))
    runs = F.regexp_count(F.col(text), F.lit(V.EXCLAMATION_RUN))
    score = (
        share(emoji, V.EMOJI_SHARE) + share(promo, V.PROMO_SHARE) + share(runs, V.EXCLAMATION_SHARE)
    ) / 2
    return (
        df.withColumn(
            "_words", F.filter(plain_words(F.col(text)), lambda word: ~word.isin(V.STOP_WORDS))
        )
        .withColumn(out, F.when(F.col(text).isNotNull(), F.least(score, F.lit(1.0))))
        .drop("_words")
    )


def curate(df: DataFrame, text: str, error: str = "error", score: str = "spam_score") -> DataFrame:
    """Replace ``text`` by null where it is too short or spam, and say why in ``error``.

    The length test comes first and leaves the score empty; both tests are strict.
    """
    df = with_spam_score(df, text, "_score").withColumn("_n_words", word_count(F.col(text)))
    short = F.col("_n_words") < V.MIN_ARTICLE_WORDS
    spam = F.col("_score") > V.MAX_SPAM_SCORE
    rejected = F.coalesce(short | spam, F.lit(False))
    return df.withColumns(
        {
            error: F.when(short, "text too short")
            .when(spam, "high spam score")
            .otherwise(F.col(error)),
            score: F.when(~short, F.col("_score")),
            text: F.when(~rejected, F.col(text)),
        }
    ).drop("_score", "_n_words")
