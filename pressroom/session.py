"""Session settings the results rely on, and the shared folder for written tables."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_STORED: list[tuple[SparkSession, str]] = []


def build_session(app_name: str = "pressroom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Pin what results depend on; leave sizing to the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Long articles travel to Arrow functions in small batches, so that a batch of the longest
    # texts still fits a Python worker.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder path below ``spark.checkpoint.dir``, which every executor can reach.

    Without that setting only a local session may go on, in a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="pressroom-")
    return os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A folder path as ``work_dir`` gives it, deleted by ``release``."""
    path = work_dir(spark, purpose)
    _STORED.append((spark, path))
    return path


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored() -> list[tuple[SparkSession, str]]:
    """The tables and folders that are not released yet."""
    return list(_STORED)


def release(tables: list[tuple[SparkSession, str]] | None = None) -> None:
    """Delete these tables, or all that ``store`` wrote; results not yet written need them."""
    for spark, path in stored() if tables is None else tables:
        if (spark, path) in _STORED:
            _STORED.remove((spark, path))
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has gone; its folder stays
            return


atexit.register(release)
