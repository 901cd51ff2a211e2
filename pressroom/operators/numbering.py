"""Row numbers in an order, over all rows or inside each key, however the rows are spread over keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pressroom.session import store

_PLACE_BITS = 33  # monotonically_increasing_id: partition above, place in the partition below


def numbered(df: DataFrame, order: list[Column | str], out: str, by: list[str] | None = None) -> DataFrame:
    """``df`` with ``out``: numbers from 0 without gaps in ``order``, inside each value of ``by`` if given.

    Rows are dealt to ranges of ``by`` and ``order`` and keep their place there; what is added up
    over ranges is one row per range (and key), so neither a frequent key nor sparse or repeated
    order values load one task. Nulls come first and are a key like others; the numbers of rows
    that are equal in ``order`` may change between runs. No rows give no rows.
    """
    by = by or []
    ranged = df.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order)
    placed = store(ranged.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_range", F.shiftright("_place", _PLACE_BITS))
    sizes = placed.groupBy("_range", *by).agg(F.count(F.lit(1)).alias("_size"), F.min("_place").alias("_first"))
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("_range").alias("_of"), *[F.col(k).alias(f"_by{i}") for i, k in enumerate(by)],
        (F.coalesce(F.sum("_size").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = F.col("_range") == F.col("_of")
    for i, key in enumerate(by):
        same &= F.col(key).eqNullSafe(F.col(f"_by{i}"))
    return placed.join(starts, same).withColumn(out, F.col("_place") + F.col("_shift")).select(*df.columns, out)
