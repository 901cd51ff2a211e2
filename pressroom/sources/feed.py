"""Landed feed pages and the parameters of the next feed request."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from pressroom import fixed_values as V
from pressroom.functions.dates import request_range
from pressroom.schemas import FEED_PAGE


def landing_of(file_path: Column) -> Column:
    """The landing a file belongs to.

    A folder named ``key=value``, or one of files that Spark wrote (``part-…``), is one landing. Any
    other file is a landing of its own, as fetches that share one folder are.
    """
    folder = F.regexp_extract(file_path, "(?s)^(.*)/", 1)
    written = file_path.rlike(r"/(?:[^/=]+=[^/]*/[^/]+|part-[^/]+)$")
    return F.when(written, folder).otherwise(file_path)


def read_feed_pages(
    spark: SparkSession,
    path: str,
    first_day: str | None = None,
    last_day: str | None = None,
    files: list[str] | None = None,
) -> DataFrame:
    """Landed JSON pages, one object per line, below ``path`` at any depth, or of ``files`` alone.

    Days bound a ``landed=YYYY-MM-DD`` folder level, and only such folders are read then.
    ``landing`` is what ``landing_of`` says of a page's file.
    """
    if files is not None:
        pages = spark.read.schema(FEED_PAGE).json(files) if files else spark.createDataFrame([], FEED_PAGE)
        if not files:
            return pages.withColumn("landing", F.lit(None).cast("string"))
    elif first_day or last_day:
        dated = T.StructType([*FEED_PAGE.fields, T.StructField("landed", T.DateType())])
        pages = spark.read.schema(dated).json(path)
        if first_day:
            pages = pages.where(F.col("landed") >= F.lit(first_day).cast("date"))
        if last_day:
            pages = pages.where(F.col("landed") <= F.lit(last_day).cast("date"))
    else:
        pages = spark.read.schema(FEED_PAGE).option("recursiveFileLookup", "true").json(path)
    return pages.withColumn("landing", landing_of(F.col("_metadata.file_path")))


def landed_files(spark: SparkSession, path: str, first_day: str | None = None) -> DataFrame:
    """``(landing, file)`` of the JSON files below ``path``, found without reading any.

    ``first_day`` leaves out folders ``landed=YYYY-MM-DD`` before it.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*")
    # Statistics of the listing alone: the content column is not asked for.
    rows = files.load(path).select(landing_of(F.col("path")).alias("landing"), F.col("path").alias("file"))
    if first_day:
        day = F.try_to_timestamp(F.nullif(F.regexp_extract("file", r"/landed=(\d{4}-\d\d-\d\d)/", 1), F.lit("")))
        rows = rows.where(F.coalesce(day >= F.lit(first_day).cast("timestamp"), F.lit(True)))
    return rows


def feed_items(pages: DataFrame) -> DataFrame:
    """Items of the pages before the first empty one, with their ``ordinal`` (feed order).

    Page numbers start again in each ``landing``, so each has a first empty page and a total of its
    own; ordinals run on over landings in order of name. Pages without that column are one landing.
    The stop and offset of all landings are one value, a map with an entry for each, found by an
    aggregate over page numbers.
    """
    landing = F.coalesce("landing", F.lit("")) if "landing" in pages.columns else F.lit("")
    pages = pages.withColumn("_landing", landing)
    empty = F.coalesce(F.size("data"), F.lit(0)) <= 0
    bounds = pages.groupBy("_landing").agg(
        F.min(F.when(empty, F.col("page"))).alias("empty"),
        F.max("total_pages").alias("total"),
        F.max("page").alias("last"),
    )
    stop = F.least(
        F.coalesce(F.col("empty"), F.lit(2**31 - 1)),
        F.coalesce(F.col("total").cast("bigint") + 1, F.lit(2**31 - 1)),
    )
    width = (F.coalesce("last", F.lit(0)).cast("bigint") + 1) * V.FEED_REQUEST["items"]
    earlier = Window.orderBy("_landing").rowsBetween(Window.unboundedPreceding, -1)  # a row per landing
    limits = bounds.select(
        "_landing", F.struct(stop.alias("stop"), F.coalesce(F.sum(width).over(earlier), F.lit(0)).alias("offset"))
    ).agg(F.map_from_entries(F.collect_list(F.struct("*"))))
    return (
        pages.withColumn("_limit", F.element_at(limits.scalar(), F.col("_landing")))
        .where(F.col("page") < F.col("_limit.stop"))
        .select("page", "_limit", F.posexplode("data").alias("pos", "item"))
        .select(
            "page",
            "pos",
            (
                F.col("_limit.offset") + F.col("page").cast("bigint") * V.FEED_REQUEST["items"] + F.col("pos")
            ).alias("ordinal"),
            "item.*",
        )
    )


def request_parameters(bounds: DataFrame) -> DataFrame:
    """The request row for ``start_date`` and ``end_date`` of the bounds frame."""
    fixed = {name: F.lit(value) for name, value in V.FEED_REQUEST.items()}
    return bounds.select(
        request_range(F.col("start_date"), F.col("end_date")).alias("date"),
        *[value.alias(name) for name, value in fixed.items()],
    )
