"""Bottom-k sketches of shingle sets as document fingerprints."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pressroom.llm.textkit import shingles

K = 128
_BITS = 48
SPAN = float(1 << _BITS)


def bottom_k(text: str | None, k: int = K, size: int = 5) -> np.ndarray:
    """The ``k`` least 48-bit hashes of the whole text's distinct shingles, ascending."""
    values = shingles(text, size)
    if len(values) > 2 * k:  # the shift keeps the order, and merges few values
        values = values[: 2 * k]
    return np.unique(values >> np.uint64(64 - _BITS))[:k]


def to_text(sketch: np.ndarray) -> str:
    """Base 64 of the values, six big-endian bytes each; empty for an empty sketch."""
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_text(fingerprint: str | None) -> np.ndarray:
    data = np.frombuffer(base64.b64decode(fingerprint or ""), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(data), 8), np.uint8)
    wide[:, 2:] = data
    return wide.view(">u8").ravel().astype(np.uint64)


def merge(sketches: list[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of the union of the sets, from sketches of its parts."""
    return np.unique(np.concatenate([*sketches, np.empty(0, np.uint64)]))[:k]


def distinct_count(sketch: np.ndarray, k: int = K) -> float:
    """Distinct shingles: exact below ``k``, estimated from the k-th least hash beyond."""
    return float(len(sketch)) if len(sketch) < k else (k - 1) * SPAN / (float(sketch[k - 1]) + 1)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Jaccard similarity of the sets; 1 for two empty ones."""
    union = merge([a, b], k)
    if not len(union):
        return 1.0
    common = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, common, assume_unique=True).sum() / len(union))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Share of the first set that the second one holds; 1 for an empty first set."""
    if not len(a):
        return 1.0
    union = distinct_count(merge([a, b], k), k)
    return min(1.0, resemblance(a, b, k) * union / distinct_count(a, k))


def fingerprints(docs: DataFrame, text_col: str = "text", k: int = K, size: int = 5) -> DataFrame:
    """``docs`` with ``fingerprint``: the sketch of each whole text as text. A null text is as an empty one."""

    @F.arrow_udf("string")
    def sketch(texts: pa.Array) -> pa.Array:
        return pa.array([to_text(bottom_k(t, k, size)) for t in texts.to_pylist()], pa.string())

    return docs.withColumn("fingerprint", sketch(F.coalesce(F.col(text_col), F.lit(""))))


def merged_fingerprints(parts: DataFrame, keys: list[str], k: int = K) -> DataFrame:
    """``(keys, fingerprint, distinct_shingles)``: the sketch of each group's union, merged in two steps.

    ``parts`` has ``fingerprint``. The first step merges within each input partition, so that a
    group of any size reaches its last task as one sketch per partition.
    """
    groups = parts.select(*keys, "fingerprint")
    values = F.explode_outer(_values(F.col("fingerprint"))).alias("_value")
    rows = groups.select(*keys, values).distinct()
    bucket = F.pmod(F.xxhash64("_value"), F.lit(64))
    least = rows.groupBy(*keys, bucket.alias("_bucket")).agg(_least("_value", k))
    final = least.select(*keys, F.explode_outer("_least").alias("_value")).groupBy(*keys).agg(_least("_value", k))
    kth = F.element_at("_least", k)
    estimate = F.when(F.size("_least") < k, F.size("_least").cast("double")).otherwise(
        F.lit((k - 1) * SPAN) / (kth.cast("double") + 1)
    )
    return final.select(*keys, _encode(F.col("_least")).alias("fingerprint"), estimate.alias("distinct_shingles"))


def _least(column: str, k: int):
    return F.slice(F.array_sort(F.collect_set(column)), 1, k).alias("_least")


@F.arrow_udf(T.ArrayType(T.LongType()))
def _values(column: pa.Array) -> pa.Array:
    return pa.array([from_text(x).astype(np.int64) for x in column.to_pylist()], pa.list_(pa.int64()))


@F.arrow_udf(T.StringType())
def _encode(column: pa.Array) -> pa.Array:
    return pa.array([to_text(np.array(x or [], np.uint64)) for x in column.to_pylist()], pa.string())


def in_order(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """``(part, tail, id, text)``: rows by ascending id in ``parts`` ranges, each followed by the next range's first row.

    Bounds are quantiles of the ids; the driver sees the bounds and the first id of each range,
    their texts stay in tasks. The last range is followed by the very first row.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    shares = [i / parts for i in range(1, parts)]
    bounds = []
    if shares:
        bounds = rows.select(F.percentile_approx("id", F.lit(shares).cast("array<double>"), 10_000)).first()[0] or []
    bounds = sorted(set(bounds))
    edges = F.lit(bounds).cast("array<long>") if bounds else F.array().cast("array<long>")
    part = F.when(F.col("id").isNull(), -1).otherwise(F.size(F.filter(edges, lambda x: x <= F.col("id"))))
    rows = rows.withColumn("part", part.cast("int"))
    firsts = rows.groupBy("part").agg(F.min("id").alias("id")).collect()  # one row per range
    ordered = sorted(firsts, key=lambda r: r["part"])
    if not ordered:
        return rows.select("part", F.lit(False).alias("tail"), "id", "text")
    before = {r["part"]: ordered[i - 1]["part"] for i, r in enumerate(ordered)}
    if ordered[0]["part"] == -1:
        heads = rows.filter((F.col("part") == -1) | F.col("id").isin([r["id"] for r in ordered[1:]]))
    else:
        heads = rows.filter(F.col("id").isin([r["id"] for r in ordered]))
    least = heads.groupBy("part").agg(F.min("id").alias("id"), F.min("text").alias("text"))
    goes = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    tails = least.select(goes[F.col("part")].alias("part"), F.lit(True).alias("tail"), "id", "text")
    return rows.select("part", F.lit(False).alias("tail"), "id", "text").union(tails)


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None, k: int = K, size: int = 5
) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, with their likeness.

    The edited text has its last ``floor(n / 4)`` code points replaced by the first as many (or
    all) of the next document's, by ascending id, nulls first, then by text; after the last comes
    the first, which for a lone document is itself. Returns ``(id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next)``; a null text is as an empty one, and two
    empty texts are alike (1). Repeated rows follow each other. No rows give no rows. Texts move
    once, dealt by ranges of the id (twice as many as shuffle partitions unless ``parts`` says);
    other columns are not looked at.
    """
    parts = parts or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = pa.schema([
        ("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            parts, tails = batch.column("part").to_pylist(), batch.column("tail").to_pylist()
            for part, tail, key, text in zip(
                parts, tails, batch.column("id").to_pylist(), batch.column("text").to_pylist()
            ):
                own = bottom_k(text, k, size)
                if held is not None and held[0] == part:
                    _, id_, before, sketch = held
                    cut = len(before) // 4
                    edited = before[: len(before) - cut] + text[:cut]
                    other = bottom_k(edited, k, size)
                    out.append((
                        id_, len(before), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                        to_text(sketch), to_text(other), resemblance(sketch, other, k), resemblance(sketch, own, k),
                    ))
                held = None if tail else (part, key, text, own)
            columns = list(zip(*out)) if out else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    dealt = in_order(docs, id_col, text_col, parts).repartition("part")
    dealt = dealt.sortWithinPartitions("part", "tail", "id", "text")
    spec = (
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return dealt.mapInArrow(work, spec).withColumnRenamed("id", id_col)
