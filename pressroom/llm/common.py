"""Session settings, written intermediate tables, and joins that a hot key does not stop."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from pressroom.session import configure, store

#: So many files at most are numbered in a table that is sent to all tasks (16 bytes a file).
FILES = 500_000


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on; Arrow batches are bounded by bytes, so long texts stay few."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def save(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors."""
    return store(df, f"llm-{purpose}")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_rows(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a unique number of each row in a new column, and its name.

    Rows read from Parquet are numbered by file and place in it, so every later read gives the same
    numbers. Other rows, or those of more than ``FILES`` files, are numbered in a written copy.
    """
    row = free_name(docs, "row_number")
    file, place = free_name(docs, "row_file"), free_name(docs, "row_place")
    try:
        read = docs.metadataColumn("_metadata")
        placed = docs.select("*", F.xxhash64(read["file_path"]).alias(file), read["row_index"].alias(place))
        files = placed.select(file).distinct()
        known = 0 < files.count() <= FILES and placed.filter(F.col(place).isNull()).isEmpty()
    except AnalysisException:  # not read from files
        known = False
    if not known:
        return save(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row
    number = F.row_number().over(Window.orderBy(file)).cast("long")
    files = save(files.withColumn(row, number), "files")
    rows = placed.join(F.broadcast(files), file)
    return rows.withColumn(row, F.shiftleft(row, 40) + F.col(place)).drop(file, place), row


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def salted_join(
    left: DataFrame, right: DataFrame, keys: list[str], by: str, how: str = "left", salts: int = 16
) -> DataFrame:
    """Join a side with hot keys to one with a single row per key.

    The unique, narrow side is repeated ``salts`` times; rows of the other are dealt by a hash of
    column ``by``. A null key meets nothing.
    """
    salt = "_salt"
    dealt = left.withColumn(salt, F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    copies = right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(copies, [*keys, salt], how).drop(salt)


def give_back() -> None:
    """Return what this Python worker has freed to the system.

    Workers live from stage to stage beside a JVM under one memory limit, and both allocators would
    keep the pages of their greatest need.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def map_batches(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | T.StructType,
) -> DataFrame:
    """``mapInArrow`` that gives freed memory back after each batch and at the end of the task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                give_back()

        yield from function(each())
        give_back()

    return df.mapInArrow(work, schema)


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Whole groups of rows with equal ``keys``, several groups to a table, from sorted batches."""
    import numpy as np

    rest: list[pa.RecordBatch] = []

    def last_start(batch: pa.RecordBatch) -> int:
        change = np.zeros(max(batch.num_rows - 1, 0), bool)
        for k in keys:
            values = batch.column(k).to_numpy(zero_copy_only=False)
            change |= values[1:] != values[:-1]
        at = np.flatnonzero(change)
        return int(at[-1]) + 1 if len(at) else 0

    def same(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
        return all(a.column(k)[a.num_rows - 1] == b.column(k)[0] for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        if rest and not same(rest[-1], batch):
            yield pa.Table.from_batches(rest)
            rest = []
        cut = last_start(batch)
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = []
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest)
