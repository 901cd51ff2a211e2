"""Mixing sources to target weights by subset sums of document sizes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pressroom.llm.common import give_back, save

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
#: Words that the dynamic programme covers at most; what is above is filled with the longest documents first.
REACH = 1 << 17
BUCKETS = 1024


@F.arrow_udf(T.LongType())
def word_count(texts: pa.Array) -> pa.Array:
    """Runs of characters other than space and U+0009 to U+000D; a null text has none."""
    give_back()
    return pa.array([len(t.split()) if t else 0 for t in texts.cast(pa.binary()).to_pylist()], pa.int64())


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``(source_key, source_size, target)`` of ``sizes(source_key, source_size)``.

    Weights repeat over the sources in order of code points, null last. The budget goes to them by
    weight; a target over ``most`` times its source's size stops there and the excess is shared
    again. The level of the water is found from sums alone, so sources stay in tasks.
    """
    ranked = ranks(sizes, "source_key")
    weight = F.element_at(F.lit(list(weights)).cast("array<double>"), (F.col("rank") % len(weights) + 1).cast("int"))
    rows = save(ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * most), "sources")
    total, full = rows.agg(F.sum("source_size"), F.sum("limit")).first()
    budget = min(share * (total or 0), full or 0.0)
    level = 0.0
    while True:
        capped = F.col("limit") <= F.lit(level) * F.col("weight")
        spent, open_weight = rows.agg(
            F.sum(F.when(capped, F.col("limit")).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
        ).first()
        if not open_weight:
            break
        higher = (budget - spent) / open_weight
        if higher <= level:
            break
        level = higher
    target = F.least(F.col("limit"), F.lit(level) * F.col("weight"))
    return rows.select("source_key", "source_size", target.alias("target"))


def ranks(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the 0-based ``rank`` of its unique ``column``, without a single task.

    Rows are sorted by ranges; each range's offset is the number of rows before it.
    """
    spread = df.repartitionByRange(F.col(column)).withColumn("_range", F.spark_partition_id())
    spread = save(spread, "ranges")
    counts = spread.groupBy("_range").agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("_first"))
    before = counts.withColumn(
        "before", F.sum("n").over(Window.orderBy("_first").rowsBetween(Window.unboundedPreceding, -1))
    ).select("_range", F.coalesce("before", F.lit(0)).alias("before"))  # a row per range
    within = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return spread.withColumn("_within", within).join(before, "_range").select(
        *df.columns, (F.col("before") + F.col("_within")).alias("rank")
    )


def fit(lengths: np.ndarray, counts: np.ndarray, budget: int, reach: int = REACH) -> np.ndarray:
    """How many documents of each length to take, so that their words come as near to ``budget`` as can be from below.

    Every length first gives the same share of its documents, then the longest ones fill what is
    over ``reach``; a bounded knapsack over lengths and remaining counts fills the rest.
    """
    take = np.zeros(len(lengths), np.int64)
    total = int((lengths * counts).sum())
    if budget <= 0 or not total:
        return take
    if budget >= total:
        return counts.astype(np.int64).copy()
    take = np.floor(counts * (max(0, budget - reach // 2) / total)).astype(np.int64)
    rest = budget - int((take * lengths).sum())
    order = np.argsort(-lengths, kind="stable")
    for i in order:
        if rest <= reach:
            break
        more = min(int(counts[i] - take[i]), (rest - reach) // int(lengths[i]) + 1, rest // int(lengths[i]))
        take[i] += more
        rest -= more * int(lengths[i])
    # Sums that can be reached are the bits of an integer; each binary part of a count adds one shift.
    # Every sum keeps the part that first made it, so that the way back needs no earlier state.
    mask = (1 << (rest + 1)) - 1
    reached, steps = 1, []
    made = np.full(rest + 1, -1, np.int32)
    for i in order:
        length, left = int(lengths[i]), int(counts[i] - take[i])
        left = min(left, rest // length)
        part = 1
        while left > 0:
            n = min(part, left)
            left -= n
            part *= 2
            grown = (reached | reached << (n * length)) & mask
            if grown != reached:
                fresh = np.frombuffer((grown ^ reached).to_bytes(rest // 8 + 1, "little"), np.uint8)
                made[np.flatnonzero(np.unpackbits(fresh, count=rest + 1, bitorder="little"))] = len(steps)
                steps.append((i, n))
                reached = grown
        if reached >> rest & 1:
            break
    goal = reached.bit_length() - 1
    while goal > 0:
        i, n = steps[made[goal]]
        take[i] += n
        goal -= n * int(lengths[i])
    return take


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 17,
    reach: int = REACH,
    size_col: str | None = None,
) -> DataFrame:
    """``(id, size, source_size, target, taken)`` per row: how many words of each document the mix takes.

    ``target`` is that of the row's source (see ``source_targets``). A document is taken whole, 0 to
    ceil(``most``) times: as often as the target holds all of the source, and once more for those
    that ``fit`` chooses by length and a seeded order of ids within a length. Null and empty texts
    have size 0; a null source is a source of its own; a null id is ordered as 0. Repeated rows may
    be told apart in any way, which changes no result. ``size_col`` names a column of words counted
    before, in place of the text. Sources of no size have target 0. No rows
    give no rows. Other columns are not looked at.
    """
    key = F.when(F.col(source_col).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source_col)))
    size = F.col(size_col).cast("long") if size_col else word_count(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), key.alias("source_key"), size.alias("size"))
    rows = rows.withColumn("draw", F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(seed)))
    rows = save(rows.withColumn("bucket", F.pmod("draw", F.lit(BUCKETS)).cast("int")), "sizes")
    fine = save(rows.groupBy("source_key", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "counts")
    lengths = fine.groupBy("source_key", "size").agg(F.sum("n").alias("n"))
    sums = lengths.groupBy("source_key").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = source_targets(sums, weights, share, most)

    def choose(rows: pd.DataFrame) -> pd.DataFrame:
        """The lengths of one source: their number is bounded by its longest document."""
        rows = rows.sort_values("size", ignore_index=True)
        total, target = int(rows["source_size"][0]), float(rows["target"][0])
        base = int(target // total) if total else 0
        size, n = rows["size"].to_numpy(), rows["n"].to_numpy()
        extra = np.zeros(len(rows), np.int64)
        real = size > 0
        extra[real] = fit(size[real], n[real], int(round(target - base * total)), reach)
        return rows.assign(base=base, extra=extra)

    spec = "source_key string, size long, n long, source_size long, target double, base long, extra long"
    plan = lengths.join(targets, "source_key").groupBy("source_key").applyInPandas(choose, spec)
    order = Window.partitionBy("source_key", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(order), F.lit(0))
    steps = fine.drop("n").join(
        fine.withColumn("before", before).select("source_key", "size", "bucket", "before"),
        ["source_key", "size", "bucket"],
    )
    steps = steps.join(plan.drop("n"), ["source_key", "size"])
    steps = save(steps, "plan")
    within = F.row_number().over(Window.partitionBy("source_key", "size", "bucket").orderBy("draw", "id"))
    out = rows.withColumn("place", within).join(steps, ["source_key", "size", "bucket"])
    chosen = (F.col("before") + F.col("place") <= F.col("extra")).cast("long")
    return out.select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * (F.col("base") + chosen)).alias("taken"),
    )


def repeated(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with each row as often as the mix takes it; rows that it does not take go."""
    times = mixed.filter("taken > 0").select(id_col, (F.col("taken") / F.col("size")).cast("int").alias("_times"))
    rows = docs.join(times.dropDuplicates([id_col]), id_col)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_copy", "_times")
