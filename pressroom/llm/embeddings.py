"""Near-duplicate vectors by iterative quantisation.

Rotations learned from a bounded sample turn unit vectors into balanced binary codes. Disjoint
substrings of the codes key the tables of a multi-index; vectors that share a bucket and whose
codes differ in few bits are candidates, and candidate groups are compared with the original
vectors in double precision, in pairs of blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressroom.llm.common import is_empty, map_batches, save
from pressroom.llm.neardup import bucket_edges, by_given_ids, classes, fixed_rows, split_buckets
from pressroom.llm.textkit import mix, seeds

SAMPLE = 20_000
BUCKET = 2048
BLOCK = 512


def learn_rotation(unit: np.ndarray, seed: int, rounds: int = 30) -> np.ndarray:
    """The rotation that brings the vectors nearest to the corners of the cube, from a random start."""
    dim = unit.shape[1]
    rotation = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))[0]
    for _ in range(rounds):
        corners = np.where(unit @ rotation >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(unit.T @ corners)
        rotation = left @ right
    return rotation


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows of length one, free of overflow and underflow."""
    matrix = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def table_layout(rows: int, threshold: float, recall: float) -> tuple[int, int, float]:
    """Bits of a table's key, number of tables, and the share of bits in which a pair at the threshold differs.

    Keys are a little shorter than the logarithm of the rows, so that buckets of unrelated vectors
    keep their size as the input grows; then so many tables that a pair at the threshold shares a
    bucket with the wanted probability.
    """
    differ = math.acos(threshold) / math.pi
    bits = min(60, max(6, math.ceil(math.log2(max(rows, 2))) - 4))
    tables = math.ceil(math.log(1 - recall) / math.log(1 - (1 - differ) ** bits))
    return bits, tables, differ


def vector_rows(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(id, given, k1, k2, vec)``: a number for each row and its own id; vectors as bytes of doubles
    with a digest, null where nothing may be linked."""
    value = F.col(vec_col).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = value.isNotNull() & finite & F.exists(value, lambda x: x != 0)
    rows = df.select(
        F.monotonically_increasing_id().alias("id"), F.col(id_col).cast("long").alias("given"), F.when(usable, value).alias("vec")
    )
    schema = pa.schema([
        ("id", pa.int64()), ("given", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("vec", pa.binary()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2, out = [], [], []
            for values in batch.column(2):
                if not values.is_valid:
                    k1.append(None), k2.append(None), out.append(None)
                    continue
                data = (values.values.to_numpy() + 0.0).tobytes()
                key = np.frombuffer(hashlib.blake2b(data, digest_size=16).digest(), np.int64)
                k1.append(int(key[0])), k2.append(int(key[1])), out.append(data)
            arrays = [*batch.columns[:2], pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return map_batches(rows, work, "id long, given long, k1 long, k2 long, vec binary")


def table_entries(distinct: DataFrame, rotations: np.ndarray, bits: int, tables: int) -> DataFrame:
    """``(key, id, code)`` for each table; ``rotations`` has one column per bit of the code."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("code", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(bits, dtype=np.uint64)
        salt = seeds(tables, 5)
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = unit_rows(fixed_rows(batch.column("vec"), rotations.shape[0], np.float64))
            signs = unit @ rotations >= 0
            packed = np.packbits(signs, axis=1)
            codes = pa.array([x.tobytes() for x in packed], pa.binary())
            for t in range(tables):
                part = signs[:, t * bits : (t + 1) * bits].astype(np.uint64) @ weights
                keys = mix(part ^ salt[t]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("id"), codes], schema=schema)

    return map_batches(distinct.select("id", "vec"), work, "key long, id long, code binary")


def cosine_linker(threshold: float):
    def linked(payload: list) -> np.ndarray:
        unit = unit_rows(np.frombuffer(b"".join(payload), np.float64).reshape(len(payload), -1))
        return unit @ unit.T >= threshold

    return linked


def candidate_edges(
    distinct: DataFrame, dim: int, rows: int, threshold: float, recall: float, sample: int, bucket: int
) -> DataFrame:
    """Edges ``(a, b)`` between vectors of ``dim`` numbers that share a bucket and have near codes."""
    chosen = distinct.orderBy(F.xxhash64("k1", "k2")).select("vec").limit(sample).toArrow()
    unit = unit_rows(fixed_rows(chosen["vec"], dim, np.float64))
    bits, tables, differ = table_layout(rows, threshold, recall)
    total = bits * tables
    learned = [learn_rotation(unit, seed) for seed in range(math.ceil(total / dim))]
    rotations = np.concatenate(learned, axis=1)[:, :total]
    most = total * differ + 4 * math.sqrt(total * differ * (1 - differ))

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(a ^ b).sum(axis=-1) <= most

    width = (total + 7) // 8
    entries = table_entries(distinct, rotations, bits, tables)
    big = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket)
    big = save(big, "buckets")
    if is_empty(big):
        return bucket_edges(entries, width, near)
    small = entries.join(big.select("key"), "key", "left_anti")
    crowded = entries.join(big.select("key"), "key", "left_semi")
    return bucket_edges(small.union(split_buckets(crowded, big, bucket)), width, near)


def vector_classes(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    threshold: float = 0.9,
    recall: float = 0.98,
    sample: int = SAMPLE,
    bucket: int = BUCKET,
    block: int = BLOCK,
) -> DataFrame:
    """``(id, class_id, n_links, copies, kept)`` per row, ids under ``id_col``'s name.

    Two vectors of one length are linked if their cosine is at least ``threshold`` (above 0);
    ``n_links`` counts the other vectors linked directly, ``class_id`` is the least id that links
    reach. Vectors that are null, empty, zero or hold null or non-finite numbers link with nothing.
    Each length with different vectors has rotations of its own, learned from at most ``sample`` of
    them; all are indexed. Equal vectors count as ``copies``. Every row is a vector, whether it has
    an id or shares one with others; a class of rows without id has a null ``class_id``; ``kept``
    marks the rows with the class's id, or its first row. No rows give no rows. Other columns are
    not looked at.
    """
    rows = save(vector_rows(df, id_col, vec_col), "vectors")
    distinct = save(
        rows.filter("vec is not null").groupBy("k1", "k2").agg(
            F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec")
        ),
        "distinct",
    )
    lengths = distinct.groupBy(F.length("vec").alias("bytes")).count().filter("count > 1").orderBy("bytes").collect()
    candidates = df.sparkSession.createDataFrame([], "a long, b long")
    for length in lengths:
        alike = distinct.filter(F.length("vec") == length["bytes"])
        found = candidate_edges(alike, length["bytes"] // 8, length["count"], threshold, recall, sample, bucket)
        candidates = candidates.union(found)
    payload = distinct.select("id", F.col("vec").alias("payload"))
    out = classes(rows.drop("vec"), distinct, candidates, payload, cosine_linker(threshold), block)
    return by_given_ids(out, id_col)
