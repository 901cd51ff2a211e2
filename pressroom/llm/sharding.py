"""Shards of whole groups of equal texts by best-fit-decreasing bin packing.

Groups of one size are alike to the packing, so it runs over the counts of group sizes, largest
first: a run of equal groups fills the shard with the tightest remaining capacity that holds one,
then the next tightest, found in a balanced tree. The task that packs holds one row per different
size (at most the square root of twice all bytes); groups find their shard by their rank among the
groups of their size.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.common import free_name, map_batches, save
from pressroom.operators.numbering import numbered

#: The capacity searched for is exact to this share of a mean shard.
PRECISION = 10_000


class Gaps:
    """Open shards by remaining capacity: a search tree balanced by random priorities."""

    def __init__(self) -> None:
        self._root: list | None = None  # [key, priority, left, right]
        self._priority = random.Random(0).random

    def _split(self, node, key):
        """Trees of the keys below ``key`` and of the others."""
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] > b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b

    def add(self, gap: int, shard: int) -> None:
        left, right = self._split(self._root, (gap, shard))
        self._root = self._merge(self._merge(left, [(gap, shard), self._priority(), None, None]), right)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Take out the shard with the least gap of at least ``size``; the lowest number among equals."""
        left, right = self._split(self._root, (size, -1))
        above, node = None, right
        while node is not None and node[2] is not None:
            above, node = node, node[2]
        if node is None:
            self._root = left
            return None
        if above is None:
            right = node[3]
        else:
            above[2] = node[3]
        self._root = self._merge(left, right)
        return node[0]


def best_fit_decreasing(
    sizes: list[int], counts: list[int], capacity: int, most: int | None = None
) -> list[tuple[int, int, int]] | None:
    """Runs ``(place in sizes, number of groups, shard)``, in order, of groups sorted by falling size.

    A group over ``capacity`` has a shard of its own. ``None`` if ``most`` shards do not suffice.
    """
    gaps, runs, made = Gaps(), [], 0
    for i, (size, count) in enumerate(zip(sizes, counts)):
        while count:
            found = gaps.take_tightest(size)
            if found is None:
                if made == most:
                    return None
                found, made = (capacity, made), made + 1
            gap, shard = found
            n = min(count, max(1, gap // size))
            runs.append((i, n, shard))
            count -= n
            if gap > n * size:
                gaps.add(gap - n * size, shard)
    return runs


def even_shards(sizes: list[int], counts: list[int], shards: int) -> list[tuple[int, int, int]]:
    """Runs as ``best_fit_decreasing`` gives them, for the least capacity at which ``shards`` suffice.

    Groups larger than the mean of what is left have a shard of their own before, so that one huge
    group does not set the capacity of all.
    """
    sizes, counts = list(sizes), list(counts)
    total = sum(s * n for s, n in zip(sizes, counts))
    own: list[tuple[int, int, int]] = []
    first, left = 0, shards
    while first < len(sizes) and left > 1 and sizes[first] * left >= total:
        own.append((first, 1, shards - left))
        total, left = total - sizes[first], left - 1
        counts[first] -= 1
        first += counts[first] == 0
    if first == len(sizes):
        return own
    sizes_left, counts_left = sizes[first:], counts[first:]
    low = max(-(-total // left), sizes_left[0])
    step = max(1, low // PRECISION)
    high, width = low, step
    best = best_fit_decreasing(sizes_left, counts_left, high, left)
    while best is None:
        low, high, width = high, high + width, 2 * width
        best = best_fit_decreasing(sizes_left, counts_left, high, left)
    while high - low > step:
        middle = (low + high) // 2
        found = best_fit_decreasing(sizes_left, counts_left, middle, left)
        low, high, best = (low, middle, found) if found else (middle, high, best)
    return own + [(first + i, n, shards - left + shard) for i, n, shard in best]


def text_size(text: Column) -> Column:
    """UTF-8 bytes and one."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def text_key(text: Column) -> Column:
    """128 bits that equal texts share; null counts as empty."""
    return F.unhex(F.substring(F.sha2(F.coalesce(text, F.lit("")), 256), 1, 32))


def group_shards(rows: DataFrame, shards: int | None, capacity: int | None = None) -> DataFrame:
    """``(key, shard)`` for every group of ``(key, size)`` rows, whose size is the sum of its rows'.

    With ``shards``, so many of nearly equal size; with ``capacity`` instead, as few as best-fit
    decreasing finds. Sizes are positive. Equal sizes are dealt in the order of ``key``.
    """
    if (shards is None) == (capacity is None) or not (shards or capacity) > 0:
        raise ValueError("give either a positive number of shards or a positive capacity")
    groups = save(rows.groupBy("key").agg(F.sum("size").alias("group_size")), "groups")
    histogram = groups.groupBy("group_size").agg(F.count(F.lit(1)).alias("n"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, counts = [], []
        for batch in batches:
            sizes += batch.column("group_size").to_pylist()
            counts += batch.column("n").to_pylist()
        runs = best_fit_decreasing(sizes, counts, capacity) if capacity else even_shards(sizes, counts, shards)
        upto: list[list[dict]] = [[] for _ in sizes]
        for i, n, shard in runs:
            before = upto[i][-1]["upto"] if upto[i] else 0
            upto[i].append({"upto": before + n, "shard": shard})
        kind = pa.list_(pa.struct([("upto", pa.int64()), ("shard", pa.int32())]))
        for k in range(0, len(sizes), 4096):
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes[k : k + 4096], pa.int64()), pa.array(upto[k : k + 4096], kind)], ["group_size", "runs"]
            )

    packed = map_batches(
        histogram.repartition(1).sortWithinPartitions(F.desc("group_size")), work,
        "group_size long, runs array<struct<upto: long, shard: int>>",
    )
    ranked = numbered(groups, ["key"], "rank", by=["group_size"]).join(save(packed, "shard-runs"), "group_size")
    mine = F.filter("runs", lambda run: run["upto"] > F.col("rank"))
    return ranked.select("key", F.element_at(mine, 1)["shard"].alias("shard"))


def assign_shards(
    docs: DataFrame, shards: int | None = 16, capacity: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)`` for every row: whole groups of equal texts in one shard.

    Size is the text's UTF-8 bytes and one; a null text is an empty one. ``slot`` numbers a shard's
    rows from 0 by id (null first) and text. Rows with a null or repeated id are rows like others;
    of rows equal in id and text either may have the lower slot. No rows give no rows. Other columns
    are ignored, whatever their names.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = save(
        docs.select(
            F.col(id_col).alias("id"), text_size(text).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            text_key(text).alias("key"),
        ), "shard-rows",
    )
    placed = rows.join(group_shards(rows, shards, capacity), "key")
    slots = numbered(placed, ["id", "key"], "slot", by=["shard"])
    return slots.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int | None = 16, capacity: int | None = None, text_col: str = "text") -> str:
    """Write whole rows of ``docs`` below ``path``, a folder for each shard; returns the folders' column.

    That column is ``shard``, or a name ``docs`` does not have.
    """
    key, name = free_name(docs, "key"), free_name(docs, "shard")
    rows = save(docs.select(text_key(F.col(text_col)).alias("key"), text_size(F.col(text_col)).alias("size")), "shard-rows")
    groups = group_shards(rows, shards, capacity).select(F.col("key").alias(key), F.col("shard").alias(name))
    joined = docs.withColumn(key, text_key(F.col(text_col))).join(groups, key).drop(key)
    joined.write.partitionBy(name).parquet(path)
    return name
