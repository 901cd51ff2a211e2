"""Word n-gram Jaccard join by chosen paths.

Each distinct set of shingles gets a MinHash row of ``POSITIONS`` values, whose (position, value)
tokens stand for the set. A run deals every set to the paths of its chosen tokens: a coin that all
sets share decides for each token, with expected 1/threshold chosen tokens per set. Paths with too
many sets are split again on further tokens, up to ``DEPTH`` times, then into pairs of blocks; the
small buckets are compared whole on compact codes. Independent runs repeat this until the target
recall. The candidate pairs so found only name groups: inside a group all distinct sets are then
compared exactly, in pairs of blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressroom.llm.common import is_empty, map_batches, salted_join, save, with_rows
from pressroom.llm.neardup import bucket_edges, by_given_ids, classes, fixed_rows, split_buckets
from pressroom.llm.textkit import mix, seeds, shingles

POSITIONS = 64
BUCKET = 2048
DEPTH = 4
BLOCK = 512
#: Codes of sets with the threshold's similarity agree in threshold * POSITIONS bytes, give or take
#: POSITIONS / 20; candidates may fall short of that by four times as much.
SLACK = 0.2


def minhash(values: np.ndarray, positions: int = POSITIONS) -> np.ndarray:
    """The least 32-bit hash of the values under each of ``positions`` functions."""
    factors = seeds(positions, 11) | np.uint64(1)
    least = np.full(positions, np.iinfo(np.uint64).max, np.uint64)
    step = (1 << 18) // positions
    for k in range(0, len(values), step):
        np.minimum(least, (values[k : k + step, None] * factors).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def run_count(recall: float, threshold: float) -> int:
    """Runs until two sets at the threshold share a small bucket with the wanted probability.

    One level brings them together with 1 - 1/e; two levels, which the largest buckets need, with
    about 1 - exp(-(1 - 1/e)).
    """
    once = 1 - math.exp(-(1 - math.exp(-1)))
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - once)))


def describe_sets(rows: DataFrame, size: int) -> DataFrame:
    """``(id, given, k1, k2, n, mh)`` per row ``(id, given, text)``: digest, number and MinHash row of its shingles.

    ``n`` is 0 where there are no words.
    """
    schema = pa.schema([
        ("id", pa.int64()), ("given", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int64()), ("mh", pa.binary()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts, rows = [], [], []
            for text in batch.column(2).to_pylist():
                values = shingles(text, size)
                digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
                keys.append(np.frombuffer(digest, np.int64))
                counts.append(len(values))
                rows.append(minhash(values).tobytes())
            keys = np.array(keys).reshape(-1, 2)
            columns = [*batch.columns[:2], pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(rows, pa.binary())], schema=schema)

    return map_batches(rows.select("id", "given", "text"), work, "id long, given long, k1 long, k2 long, n long, mh binary")


def deal(rows: DataFrame, rounds: int, threshold: float) -> DataFrame:
    """``(key, id, code)``: each row to the buckets of its chosen tokens.

    ``rows`` has ``(id, mh)`` for the first level, ``(key, id, mh)`` below a bucket.
    """
    below = "key" in rows.columns
    limit = np.uint64(int(2**64 / (threshold * POSITIONS)) if threshold * POSITIONS > 1 else 2**64 - 1)
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64()), ("code", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = seeds(POSITIONS, 3)
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes = fixed_rows(batch.column("mh"), POSITIONS, np.uint32)
            ids = batch.column("id").to_numpy()
            codes = np.array([x.tobytes() for x in hashes.astype(np.uint8)], dtype=object)
            token = mix(hashes.astype(np.uint64) + place)
            for r in range(1 if below else rounds):
                path = batch.column("key").to_numpy().view(np.uint64)[:, None] if below else seeds(1, 1000 + r)
                coin = mix(token ^ path)
                row, position = np.nonzero(coin < limit)
                keys = mix(coin[row, position] + np.uint64(1)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(ids[row]), pa.array(codes[row], pa.binary())], schema=schema
                )

    columns = ["key", "id", "mh"] if below else ["id", "mh"]
    return map_batches(rows.select(*columns), work, "key long, id long, code binary")


def candidate_edges(sets: DataFrame, threshold: float, recall: float, bucket: int, depth: int) -> DataFrame:
    """Edges ``(a, b)`` between sets whose codes look alike, from every bucket of every run."""
    enough = (threshold - SLACK) * POSITIONS

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a == b).sum(axis=-1) >= enough

    entries = deal(sets, run_count(recall, threshold), threshold)
    found = None
    for level in range(1, depth + 1):
        big = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > bucket)
        big = save(big, "buckets")
        full = is_empty(big)
        small = entries if full else entries.join(big.select("key"), "key", "left_anti")
        edges = bucket_edges(small, POSITIONS, near)
        found = edges if found is None else found.union(edges)
        if full:
            return found
        crowded = salted_join(entries, big, ["key"], by="id", how="inner")
        if level == depth:
            return found.union(bucket_edges(split_buckets(crowded.drop("n"), big, bucket), POSITIONS, near))
        entries = save(deal(crowded.select("key", "id").join(sets.select("id", "mh"), "id"), 1, threshold), "paths")
    return found


def shingle_linker(threshold: float, size: int):
    """Which of some texts have a Jaccard similarity of at least ``threshold``, from whole shingle sets."""

    def linked(texts: list) -> np.ndarray:
        sets = [shingles(t, size) for t in texts]
        lengths = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), lengths)
        _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = counts > 1
        use = shared[column]
        owner, column = owner[use], (np.cumsum(shared) - 1)[column[use]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        n, total = len(sets), int(shared.sum())
        common = np.zeros((n, n), np.float32)
        step = max(256, (1 << 22) // n)
        for k in range(0, total, step):
            lo, hi = np.searchsorted(column, [k, k + step])
            matrix = np.zeros((n, min(step, total - k)), np.float32)
            matrix[owner[lo:hi], column[lo:hi] - k] = 1
            common += matrix @ matrix.T
        return common >= threshold * (lengths[:, None] + lengths[None, :] - common.astype(np.float64)) - 1e-6

    return linked


def jaccard_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    threshold: float = 0.8,
    recall: float = 0.999,
    bucket: int = BUCKET,
    depth: int = DEPTH,
    block: int = BLOCK,
    unique: bool = False,
) -> DataFrame:
    """``(id, class_id, n_links, copies, n_shingles, kept)`` per row, ids under ``id_col``'s name.

    Two documents are linked if the Jaccard similarity of their shingles is at least ``threshold``;
    ``n_links`` counts the other documents linked directly, copies included, and ``class_id`` is
    the least id that links reach. Documents with equal shingles are one set with ``copies``
    members. Null, empty and wordless texts link with nothing; texts under ``size`` words are one
    shingle of all their words. Every row is a document, whether it has an id or shares one with
    others: rows are told apart by their place in the files, or without files in a saved copy, or by
    their id where it is said to be ``unique``. A class of rows without id has a null ``class_id``;
    ``kept`` marks the rows with the class's id, or its first row. No rows give no rows. Other
    columns are not looked at.
    """
    rows, row = (docs, id_col) if unique else with_rows(docs.select(id_col, text_col))
    rows = rows.select(
        F.col(row).cast("long").alias("id"), F.col(id_col).cast("long").alias("given"), F.col(text_col).alias("text")
    )
    sets = save(describe_sets(rows, size), "sets")
    distinct = sets.filter("n > 0").groupBy("k1", "k2").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("mh").alias("mh")
    )
    distinct = save(distinct, "distinct")
    candidates = candidate_edges(distinct, threshold, recall, bucket, depth)
    texts = rows.select("id", F.col("text").alias("payload"))
    out = classes(sets.drop("mh"), distinct, candidates, texts, shingle_linker(threshold, size), block)
    return by_given_ids(out.withColumnRenamed("n", "n_shingles"), id_col)
