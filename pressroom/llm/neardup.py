"""What similarity joins share: buckets of compact codes to candidate edges, and exact checks by blocks.

Candidate groups are compared in pairs of blocks of bounded size, one pair to a group of rows, so
that a group of thousands is spread over tasks and no list of all pairs is ever written: a block
pair returns, per member, a count of links and one link towards the least member it reaches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pressroom.llm.common import map_batches, runs, salted_join, save
from pressroom.llm.components import components

Near = Callable[[np.ndarray, np.ndarray], np.ndarray]
Linker = Callable[[list], np.ndarray]
NARROW = 32
CELLS = 1 << 22


def fixed_rows(column: pa.ChunkedArray, width: int, dtype=np.uint8) -> np.ndarray:
    """Equally long binary values as the rows of a matrix."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, dtype).reshape(len(column), width)


def starts_of(keys: np.ndarray) -> np.ndarray:
    """First row of each run of equal keys, and the row count."""
    change = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate(([0], change, [len(keys)]))


def forest(codes: np.ndarray, ids: np.ndarray, near: Near) -> tuple[np.ndarray, np.ndarray]:
    """Each member with the least member that a chain of near codes reaches, in bounded memory."""
    order = np.argsort(ids, kind="stable")
    codes, ids = codes[order], ids[order]
    left, root = np.arange(1, len(ids)), np.zeros(len(ids), np.int64)
    at = np.array([0])
    first = 0
    step = max(1, CELLS // max(1, codes.shape[1] * len(ids)))
    while True:
        reached = []
        for k in range(0, len(at), step):
            if not len(left):
                break
            hit = near(codes[at[k : k + step], None], codes[None, left]).any(axis=0)
            reached.append(left[hit])
            left = left[~hit]
        at = np.concatenate(reached) if reached else np.empty(0, np.int64)
        if len(at):
            root[at] = first
        elif len(left):
            first, left = int(left[0]), left[1:]
            root[first] = first
            at = np.array([first])
        else:
            break
    own = root != np.arange(len(ids))
    return ids[own], ids[root[own]]


def bucket_edges(entries: DataFrame, width: int, near: Near) -> DataFrame:
    """Candidate edges ``(a, b)`` among rows ``(key, id, code)`` of equal key; every bucket is compared whole.

    Narrow buckets give their near pairs, wider ones a spanning forest. Keys with one row give none.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        for group in runs(batches, ["key"]):
            keys = group["key"].to_numpy()
            ids = group["id"].to_numpy()
            if len(keys) < 2:
                continue
            codes = fixed_rows(group["code"], width)
            bounds = starts_of(keys)
            sizes = np.diff(bounds)
            wide = sizes > NARROW
            slim = ~np.repeat(wide, sizes)
            found_a, found_b = [], []
            for d in range(1, min(NARROW, len(keys))):
                pair = np.flatnonzero((keys[d:] == keys[:-d]) & slim[d:])
                if not len(pair):
                    break
                pair = pair[near(codes[pair], codes[pair + d])]
                found_a.append(ids[pair])
                found_b.append(ids[pair + d])
            for k in np.flatnonzero(wide):
                lo, hi = bounds[k], bounds[k + 1]
                a, b = forest(codes[lo:hi], ids[lo:hi], near)
                found_a.append(a)
                found_b.append(b)
            if found_a:
                pairs = np.stack([np.concatenate(found_a), np.concatenate(found_b)], axis=1)
                pairs = np.unique(np.sort(pairs[pairs[:, 0] != pairs[:, 1]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    dealt = entries.select("key", "id", "code").repartition("key").sortWithinPartitions("key")
    return map_batches(dealt, work, "a long, b long")


def split_buckets(entries: DataFrame, big: DataFrame, size: int) -> DataFrame:
    """The exact way for buckets over ``size``: each becomes pairs of blocks, which together hold every pair.

    ``big(key, n)`` has one row per such bucket.
    """
    blocks = F.ceil(F.col("n") * 2 / size).cast("int")
    dealt = salted_join(entries, big, ["key"], by="id", how="inner").withColumn("blocks", blocks)
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    pair = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    return dealt.select(pair.alias("key"), "id", "code")


def block_pairs(members: DataFrame, size: int) -> DataFrame:
    """``members(id, component, ...)`` dealt to the block pairs of their component.

    Adds ``pair`` (the block pair), ``block`` (the row's own) and ``diagonal``. Each two members of
    a component meet in exactly one pair.
    """
    counts = members.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / size).cast("int")
    dealt = salted_join(members, counts, ["component"], by="id", how="inner").withColumn("blocks", blocks)
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return dealt.withColumns({
        "low": low,
        "high": high,
        "pair": F.xxhash64("component", low, high),
        "diagonal": low == high,
    }).drop("blocks", "other", "n")


def roots(linked: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The least id that each member reaches over a symmetric matrix of links."""
    out, open_ = ids.copy(), linked.any(axis=1)
    for start in np.argsort(ids, kind="stable"):
        if not open_[start]:
            continue
        at = np.zeros(len(ids), bool)
        at[start] = True
        while at.any():
            out[at] = ids[start]
            open_ &= ~at
            at = linked[at].any(axis=0) & open_
    return out


def compare_blocks(dealt: DataFrame, linker: Linker) -> DataFrame:
    """``(id, root, links)`` per member of each block pair with a link.

    ``dealt`` is what ``block_pairs`` gives, with ``payload`` and ``copies``; ``linker`` says of a
    list of payloads which are linked, as a square matrix.
    """
    schema = pa.schema([("id", pa.int64()), ("root", pa.int64()), ("links", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["pair"]):
            bounds = starts_of(group["pair"].to_numpy())
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                part = group.slice(lo, hi - lo)
                ids, first = np.unique(part["id"].to_numpy(), return_index=True)
                part = part.take(pa.array(first))
                linked = linker(part["payload"].to_pylist()) & (ids[:, None] != ids[None, :])
                if not part["diagonal"][0].as_py():
                    block = part["block"].to_numpy()
                    linked &= block[:, None] != block[None, :]
                if linked.any():
                    links = linked.astype(np.float64) @ part["copies"].to_numpy().astype(np.float64)
                    arrays = [pa.array(ids), pa.array(roots(linked, ids)), pa.array(links.astype(np.int64))]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    columns = ["pair", "diagonal", "block", "id", "copies", "payload"]
    dealt = dealt.select(*columns).repartition("pair").sortWithinPartitions("pair", "id", F.xxhash64("payload"))
    return map_batches(dealt, work, "id long, root long, links long")


def classes(
    rows: DataFrame, distinct: DataFrame, candidates: DataFrame, payload: DataFrame, linker: Linker, block: int
) -> DataFrame:
    """``rows(id, k1, k2)`` with the class of each, its links and its copies.

    ``distinct(k1, k2, id, copies)`` has the least id of equal rows, ``candidates(a, b)`` joins
    those that may be linked, directly or in steps, and ``payload(id, payload)`` is what is compared.
    """
    groups = components(save(candidates, "candidates")).withColumnRenamed("node", "id")
    members = save(block_pairs(groups.join(distinct.select("id", "copies"), "id"), block), "pairs")
    # What is compared is large and its members are not: both sides are dealt by id at every size.
    checked = save(compare_blocks(members.join(payload.hint("merge"), "id"), linker), "checked")
    links = checked.groupBy("id").agg(F.sum("links").alias("links"))
    edges = checked.filter("root != id").select(F.col("id").alias("a"), F.col("root").alias("b"))
    found = links.join(components(edges).withColumnRenamed("node", "id"), "id", "left")
    by_key = distinct.join(found, "id", "left").select(
        "k1", "k2", "copies", "links", F.coalesce("component", "id").alias("class_id")
    )
    out = salted_join(rows, by_key, ["k1", "k2"], by="id")
    return out.withColumns({
        "class_id": F.coalesce("class_id", "id"),
        "n_links": F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)),
        "copies": F.coalesce("copies", F.lit(1)),
    }).drop("k1", "k2", "links")


def by_given_ids(out: DataFrame, id_col: str) -> DataFrame:
    """Classes of rows named by their least id: ``out`` has each row's number ``id`` and its ``given`` id.

    Rows without id belong to classes like others; a class of such rows alone has a null name.
    ``kept`` marks the rows with the class's name, or the first row of a class without one.
    """
    least = out.groupBy("class_id").agg(F.min("given").alias("least"))
    named = salted_join(out, least, ["class_id"], by="id")
    kept = F.when(F.col("given").isNotNull(), F.col("given") == F.col("least")).otherwise(
        F.col("least").isNull() & (F.col("id") == F.col("class_id"))
    )
    named = named.withColumn("kept", kept).drop("id", "class_id")
    return named.withColumnsRenamed({"given": id_col, "least": "class_id"})
