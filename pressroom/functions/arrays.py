"""Arrays to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def explode_rows(df: DataFrame, keep: list[str], array: Column | str, index: str, value: str) -> DataFrame:
    """One row per array element, with its position.

    The outer form is used on purpose: for the inner one Spark infers a filter on the array, and
    pushing that filter down would compute a derived array twice.
    """
    rows = df.select(*keep, F.posexplode_outer(array).alias(index, value))
    return rows.where(F.col(index).isNotNull())
