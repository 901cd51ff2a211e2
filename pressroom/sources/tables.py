"""Stored tables on plain Parquet: typed reads, first writes and keyed upserts.

An upsert rewrites only the partitions that hold new rows or old versions of them. The merged
partitions are first written whole to a stage folder; Spark's ``_SUCCESS`` file there marks the
write as decided. Only then are the table's partitions replaced, and a run that died in between
is completed by the next write. One writer at a time; read a table again after writing it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F
from pyspark.sql import types as T

from pressroom.schemas import TABLES, TableSpec

_BUCKET = "key_bucket"


def filters_to_column(filters: Iterable[tuple]) -> Column:
    """Conjunction of ``(column, op, value)`` with op ``=`` or ``in``.

    ``in`` is for short literal lists; sets of ids belong in a semi join.
    """
    result = F.lit(True)
    for name, op, value in filters:
        if op == "=":
            result = result & (F.col(name) == value)
        elif op == "in":
            result = result & F.col(name).isin(list(value))
        else:
            raise ValueError(f"unsupported filter operator {op!r}")
    return result


def normalize_lists(df: DataFrame) -> DataFrame:
    """Null arrays become empty arrays in every array column."""
    arrays = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    return df.withColumns(
        {name: F.coalesce(F.col(name), F.array().cast(df.schema[name].dataType)) for name in arrays}
    )


def keep_last_per_key(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """The last row of each key; rows without a key all stay, as in a merge.

    Keyless rows get a number each, which also spreads them over the tasks. The rank filter is
    applied before the shuffle too, so a key with very many rows does not gather in one task.
    """
    order = [F.col(name).desc_nulls_last() for name in order_by] or [F.lit(0)]
    numbered = df.withColumn(
        "_keyless", F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    )
    ranked = numbered.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(key, "_keyless").orderBy(*order))
    )
    return ranked.where(F.col("_rank") == 1).drop("_rank", "_keyless")


def merge_rows(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the source, and all source rows."""
    return target.join(source.select(key), key, "left_anti").unionByName(source)


def merge_counts(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: how many source rows a merge would insert, how many target rows it would update."""
    updated = target.join(source.select(key), key, "left_semi").select(
        F.lit(1).alias("updated"), F.lit(0).alias("inserted")
    )
    inserted = source.join(target.select(key), key, "left_anti").select(
        F.lit(0).alias("updated"), F.lit(1).alias("inserted")
    )
    return updated.unionByName(inserted).agg(
        F.coalesce(F.sum("inserted"), F.lit(0)).alias("rows_inserted"),
        F.coalesce(F.sum("updated"), F.lit(0)).alias("rows_updated"),
    )


class Warehouse:
    """The stored tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, TableSpec] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.tables = tables or TABLES

    # -- reading ---------------------------------------------------------------------------

    def exists(self, name: str) -> bool:
        return self._has(f"{self._data(self.tables[name])}/_SUCCESS")

    def read_table(
        self, name: str, filters: Iterable[tuple] = (), columns: Sequence[str] | None = None
    ) -> DataFrame:
        """Rows passing ``filters``; a table not yet written reads as an empty typed frame."""
        spec = self.tables[name]
        if self.exists(name):
            rows = self._scan(spec, self._data(spec))
        else:
            rows = self.spark.createDataFrame([], self._stored_schema(spec))
        if filters:
            rows = rows.where(filters_to_column(filters))
        return rows.select(*(columns or spec.schema.names))

    def read_rows_of(self, name: str, ids: DataFrame) -> DataFrame:
        """Rows whose key is among ``ids``, a semi join.

        The key alone says nothing about partitions, so a first scan of key and partition columns
        finds the partitions at hand; the wide scan then reads no others.
        """
        spec = self.tables[name]
        rows = self.read_table(name)
        if not self.exists(name):
            return rows
        by, keys = self._partition_columns(spec), ids.select(spec.key)
        scan = self._scan(spec, self._data(spec))
        where = scan.select(spec.key, *by).join(keys, spec.key, "left_semi").select(*by).distinct()
        # At most one row per table partition.
        labels = [self._label(spec, row) for row in where.collect()]
        wanted = scan.where(self._label_column(spec).isin(labels)) if labels else scan.limit(0)
        return wanted.join(keys, spec.key, "left_semi").select(*spec.schema.names)

    # -- writing ---------------------------------------------------------------------------

    def write_table(
        self, name: str, df: DataFrame, order_by: Sequence[str] = (), unique: bool = False
    ) -> dict[str, int]:
        """Create the table or merge ``df`` into it by key; returns rows inserted and updated.

        Several rows of one key: the last by ``order_by`` counts. ``unique`` says that the keys
        are known to be distinct, which saves a shuffle.
        """
        spec = self.tables[name]
        self._finish_interrupted(spec)
        if not unique:
            df = keep_last_per_key(df, spec.key, order_by)
        rows = self._conform(spec, df)
        if not self.exists(name):
            return self._create(spec, rows)
        return self._merge(spec, rows)

    def _create(self, spec: TableSpec, rows: DataFrame) -> dict[str, int]:
        seen = Observation()
        counted = self._clustered(spec, rows).observe(seen, F.count(F.lit(1)).alias("n"))
        self._write(spec, counted, self._data(spec))
        return {"rows_inserted": seen.get["n"], "rows_updated": 0}

    def _merge(self, spec: TableSpec, rows: DataFrame) -> dict[str, int]:
        by, stage = self._partition_columns(spec), f"{self._home(spec)}/stage-{uuid.uuid4().hex}"
        # The batch is computed once; counting, locating and merging read it back.
        rows.write.parquet(f"{stage}/source")
        source = self.spark.read.schema(self._stored_schema(spec)).parquet(f"{stage}/source")
        target = self._scan(spec, self._data(spec))
        replaced = target.select(spec.key, *by).join(source.select(spec.key), spec.key, "left_semi")
        # At most two rows per table partition: its new rows, and its rows about to be replaced.
        counts = (
            source.groupBy(*by)
            .count()
            .withColumn("fresh", F.lit(True))
            .unionByName(replaced.groupBy(*by).count().withColumn("fresh", F.lit(False)))
            .collect()
        )
        total = sum(row["count"] for row in counts if row["fresh"])
        updated = sum(row["count"] for row in counts if not row["fresh"])
        if total:
            filled = {self._label(spec, row) for row in counts if row["fresh"]}
            touched = {self._label(spec, row) for row in counts}
            if touched - filled:
                self._note(f"{stage}/vacated", touched - filled)
            current = target.where(self._label_column(spec).isin(sorted(touched)))
            merged = merge_rows(current, source, spec.key)
            self._write(spec, self._clustered(spec, merged), f"{stage}/merged")
            self._apply(spec, stage)
        self._delete(stage)
        return {"rows_inserted": total - updated, "rows_updated": updated}

    def _apply(self, spec: TableSpec, stage: str) -> None:
        """Put the staged partitions in place; may be repeated.

        A partition that only gave rows away may have none left, and is not overwritten then.
        """
        by = self._partition_columns(spec)
        merged = self._scan(spec, f"{stage}/merged")
        (
            merged.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*by)
            .parquet(self._data(spec))
        )
        if self._has(f"{stage}/vacated/_SUCCESS"):
            vacated = {row["label"] for row in self.spark.read.parquet(f"{stage}/vacated").collect()}
            filled = {self._label(spec, row) for row in merged.select(*by).distinct().collect()}
            for label in vacated - filled:
                self._delete(f"{self._data(spec)}/{label}")

    def _note(self, path: str, labels: set[str]) -> None:
        rows = self.spark.createDataFrame([(label,) for label in sorted(labels)], "label string")
        rows.coalesce(1).write.parquet(path)

    def _finish_interrupted(self, spec: TableSpec) -> None:
        for stage in self._list(self._home(spec), "stage-"):
            if self._has(f"{stage}/merged/_SUCCESS"):
                self._apply(spec, stage)
            self._delete(stage)

    # -- layout ----------------------------------------------------------------------------

    def _home(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.path}"

    def _data(self, spec: TableSpec) -> str:
        return f"{self._home(spec)}/data"

    def _partition_columns(self, spec: TableSpec) -> list[str]:
        return spec.partitions or [_BUCKET]

    def _stored_schema(self, spec: TableSpec) -> T.StructType:
        if spec.partitions:
            return spec.schema
        return T.StructType(spec.schema.fields + [T.StructField(_BUCKET, T.IntegerType())])

    def _scan(self, spec: TableSpec, path: str) -> DataFrame:
        schema = self._stored_schema(spec)
        return self.spark.read.schema(schema).parquet(path).select(*schema.names)

    def _conform(self, spec: TableSpec, df: DataFrame) -> DataFrame:
        have = set(df.columns)
        columns = [
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in spec.schema.fields
        ]
        rows = normalize_lists(df.select(*columns))
        if not spec.partitions:
            bucket = F.pmod(F.crc32(F.coalesce(F.col(spec.key), F.lit(""))), spec.buckets)
            rows = rows.withColumn(_BUCKET, bucket.cast("int"))
        return rows

    def _clustered(self, spec: TableSpec, rows: DataFrame) -> DataFrame:
        """Gather partitions into few files; adaptive execution splits an oversized partition."""
        return rows.hint("rebalance", *[F.col(name) for name in self._partition_columns(spec)])

    def _write(self, spec: TableSpec, rows: DataFrame, path: str) -> None:
        rows.write.partitionBy(*self._partition_columns(spec)).parquet(path)

    def _label(self, spec: TableSpec, row) -> str:
        return "/".join(
            f"{name}={'__HIVE_DEFAULT_PARTITION__' if row[name] is None else row[name]}"
            for name in self._partition_columns(spec)
        )

    def _label_column(self, spec: TableSpec) -> Column:
        null = F.lit("__HIVE_DEFAULT_PARTITION__")
        return F.concat_ws(
            "/",
            *[
                F.concat(F.lit(f"{name}="), F.coalesce(F.col(name).cast("string"), null))
                for name in self._partition_columns(spec)
            ],
        )

    # -- files -----------------------------------------------------------------------------

    def _fs(self, path: str):
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jpath.getFileSystem(self.spark._jsc.hadoopConfiguration()), jpath

    def _has(self, path: str) -> bool:
        fs, jpath = self._fs(path)
        return fs.exists(jpath)

    def _delete(self, path: str) -> None:
        fs, jpath = self._fs(path)
        fs.delete(jpath, True)

    def _list(self, path: str, prefix: str) -> list[str]:
        fs, jpath = self._fs(path)
        if not fs.exists(jpath):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(jpath)]
        return [f"{path}/{name}" for name in names if name.startswith(prefix)]
