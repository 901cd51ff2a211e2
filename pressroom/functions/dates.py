"""Feed dates, fetch bounds and display formats."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EASTERN = "US/Eastern"


def parse_feed_date(text: Column) -> Column:
    """UTC timestamp of an RFC 2822 or ISO 8601 text; null when it is neither."""
    bare = F.regexp_replace(F.trim(text), r"^[A-Za-z]{3,9},\s*", "")
    bare = F.regexp_replace(bare, r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    return F.coalesce(
        F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), bare.try_cast("timestamp")
    )


def date_parts(stamp: str = "date_utc") -> dict[str, Column]:
    return {
        "year_utc": F.year(stamp),
        "month_utc": F.month(stamp),
        "day_utc": F.dayofmonth(stamp),
    }


def eastern(stamp: Column) -> Column:
    return F.from_utc_timestamp(stamp, EASTERN)


def request_range(start: Column, end: Column) -> Column:
    """``MMDDYYYY-MMDDYYYY``"""
    return F.concat_ws("-", F.date_format(start, "MMddyyyy"), F.date_format(end, "MMddyyyy"))


def range_text(start: Column, end: Column) -> Column:
    return F.concat_ws(
        " to ", F.date_format(start, "yyyy-MM-dd"), F.date_format(end, "yyyy-MM-dd")
    )


def percent_text(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent with one decimal, exact ties to the even digit.

    Spark's own formatting rounds the shortest decimal form of a number, which puts ties, and
    numbers that only look like ties, one step higher. Here ``twice`` is the exact sign of the
    distance to the middle between two tenths: both differences are of numbers so close that
    floating point subtracts them without error.
    """
    value = part / whole * 100
    low = F.floor(value * 10)
    twice = value * 4 - ((low * 2 + 1) - value * 16)
    tenths = low + F.when(twice > 0, 1).when(twice < 0, 0).otherwise(low % 2)
    return F.concat(F.floor(tenths / 10), F.lit("."), tenths % 10, F.lit("%"))
