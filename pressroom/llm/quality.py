"""Document quality by a byte-level convolutional network in numpy."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

FILTERS = 24
WIDTH = 7
#: Positions of a block, blocks of a chunk and blocks between chunk starts: chunks of 256 bytes share 32 with the next.
BLOCK, BLOCKS, STEP = 32, 8, 7
PIECE = 2048 * BLOCK
#: Labelled rows of each class, and chunks of each of their texts, that a fit takes at most.
PER_CLASS = 2_500
CHUNKS = 8


@dataclass
class Network:
    """Filters as one table of bytes per position, and weights of the pooled features."""

    table: np.ndarray  # (WIDTH, 256, FILTERS)
    bias: np.ndarray  # (FILTERS,)
    weights: np.ndarray  # (2 * FILTERS,): mean and greatest response over chunks
    offset: float

    @staticmethod
    def constant(probability: float) -> Network:
        odds = np.log(max(probability, 1e-3) / max(1 - probability, 1e-3))
        zeros = np.zeros((WIDTH, 256, FILTERS), np.float32)
        return Network(zeros, np.zeros(FILTERS, np.float32), np.zeros(2 * FILTERS, np.float32), float(odds))

    def responses(self, windows: np.ndarray) -> np.ndarray:
        """Filter responses at each position whose ``WIDTH`` bytes are columns ``[..., t : t + WIDTH]``."""
        n = windows.shape[-1] - WIDTH + 1
        total = self.table[0].take(windows[..., :n], axis=0)
        for k in range(1, WIDTH):
            total += self.table[k].take(windows[..., k : k + n], axis=0)
        return total

    def block_greatest(self, data: np.ndarray) -> np.ndarray:
        """Greatest response of each filter in each block; ``data`` is whole blocks and ``WIDTH - 1`` more bytes."""
        n = len(data) - WIDTH + 1
        parts = []
        for at in range(0, n, PIECE):
            part = self.responses(data[at : min(at + PIECE, n) + WIDTH - 1])
            parts.append(part.reshape(-1, BLOCK, FILTERS).max(axis=1))
        return np.concatenate(parts)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Probability of label 1 for each whole text; an empty text has one block of zeros."""
        out = np.empty(len(texts))
        group: list[int] = []
        weight = 0
        for i in range(len(texts) + 1):
            if group and (i == len(texts) or weight + len(texts[i]) > 1 << 19):
                out[group] = self._group([texts[g] for g in group])
                group, weight = [], 0
            if i < len(texts):
                group.append(i)
                weight += len(texts[i])
        return out

    def _group(self, texts: list[bytes]) -> np.ndarray:
        blocks = np.array([max(1, -(-len(t) // BLOCK)) for t in texts])
        # A block of zeros parts each text from the next, whose bytes its last windows must not see.
        padded = b"".join([t.ljust((n + 1) * BLOCK, b"\0") for t, n in zip(texts, blocks.tolist())])
        data = np.frombuffer(padded + bytes(WIDTH - 1), np.uint8)
        greatest = np.maximum(self.block_greatest(data) + self.bias, 0)
        chunks = np.maximum(1, -(-(blocks - (BLOCKS - STEP)) // STEP))
        first = np.cumsum(blocks + 1) - blocks - 1
        number = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        start = np.repeat(first, chunks) + number * STEP
        stop = np.minimum(start + BLOCKS, np.repeat(first + blocks, chunks))
        ends = np.stack([start, stop], axis=1).ravel()
        spare = np.concatenate([greatest, np.zeros((1, FILTERS), greatest.dtype)])
        pooled = np.maximum.reduceat(spare, ends, axis=0)[::2]
        heads = np.cumsum(chunks) - chunks
        mean = np.add.reduceat(pooled, heads, axis=0) / chunks[:, None]
        most = np.maximum.reduceat(pooled, heads, axis=0)
        logit = np.concatenate([mean, most], axis=1) @ self.weights + self.offset
        return 1 / (1 + np.exp(-np.clip(logit.astype(np.float64), -40, 40)))


def training_chunks(text: bytes, seed: int, count: int = CHUNKS) -> np.ndarray:
    """Up to ``count`` of a text's chunks, drawn from all over it."""
    size = BLOCK * BLOCKS + WIDTH - 1
    starts = np.arange(0, max(1, len(text) - BLOCK * (BLOCKS - STEP)), BLOCK * STEP)
    if len(starts) > count:
        starts = np.sort(np.random.default_rng(seed).choice(starts, count, replace=False))
    return np.frombuffer(b"".join(text[s : s + size].ljust(size, b"\0") for s in starts), np.uint8).reshape(-1, size)


def train(chunks: list[np.ndarray], labels: np.ndarray, epochs: int = 10, seed: int = 5) -> Network:
    """Fit by Adam on documents given as chunk matrices; one class alone gives a constant."""
    if not len(labels) or labels.min() == labels.max():
        return Network.constant(float(labels.mean()) if len(labels) else 0.5)
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32), np.full(FILTERS, 0.1, np.float32),
        rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32), 0.0,
    )
    params = [net.table, net.bias, net.weights, np.zeros(1, np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.001
        order = rng.permutation(len(labels))
        for k in range(0, len(order), 64):
            docs = order[k : k + 64]
            gradients = _gradients(net, params[3], [chunks[i] for i in docs], labels[docs])
            step += 1
            for p, g, m, v in zip(params, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    net.offset = float(params[3][0])
    return net


def _gradients(net: Network, offset: np.ndarray, docs: list[np.ndarray], labels: np.ndarray) -> list[np.ndarray]:
    counts = np.array([len(d) for d in docs])
    data = np.concatenate(docs)
    response = net.responses(data)
    place = response.argmax(axis=1)
    pooled = np.maximum(np.take_along_axis(response, place[:, None], axis=1)[:, 0] + net.bias, 0)
    heads = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(docs)), counts)
    mean = np.add.reduceat(pooled, heads, axis=0) / counts[:, None]
    most = np.maximum.reduceat(pooled, heads, axis=0)
    features = np.concatenate([mean, most], axis=1)
    logit = features @ net.weights + offset[0]
    error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels) / len(docs)
    back = error[:, None] * net.weights[None, :]
    inward = back[owner, :FILTERS] / counts[owner, None]
    inward = inward + back[owner, FILTERS:] * (pooled == most[owner])
    inward = np.where(pooled > 0, inward, 0).astype(np.float32)
    table = np.empty_like(net.table)
    column = np.arange(FILTERS)
    for k in range(WIDTH):
        seen = np.take_along_axis(data, place + k, axis=1).astype(np.int64)
        flat = np.bincount((seen * FILTERS + column).ravel(), inward.ravel(), minlength=256 * FILTERS)
        table[k] = flat.reshape(256, FILTERS)
    return [
        table + 1e-5 * net.table, inward.sum(axis=0), features.T @ error + 1e-4 * net.weights, np.array([error.sum()]),
    ]


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "quality", per_class: int = PER_CLASS,
) -> Network:
    """A network learned from at most ``per_class`` labelled rows of each class, the first by a hash of their id.

    Only chunks drawn from those texts reach the driver, ``CHUNKS`` to a document. Rows with a null
    id or a label other than 0 and 1 are passed over; no labelled text, or one class alone, gives
    a constant score. Ids and all other columns decide which rows are learned from, nothing else.
    """
    usable = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("_label"))
    picked = None
    for value in (0, 1):
        part = usable.filter(F.col("_label") == value).orderBy(F.xxhash64(id_col), id_col).limit(per_class)
        picked = part if picked is None else picked.union(part)

    @F.arrow_udf("binary")
    def drawn(texts: pa.Array) -> pa.Array:
        return pa.array([training_chunks(t, len(t)).tobytes() for t in texts.to_pylist()], pa.binary())

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col), text.alias("_text")).join(F.broadcast(picked), id_col)
    # A broadcast of at most 2 * per_class rows of two numbers.
    sample = rows.select("_label", F.col(id_col), drawn("_text").alias("chunks")).toArrow().sort_by(id_col)
    size = BLOCK * BLOCKS + WIDTH - 1
    chunks = [np.frombuffer(c, np.uint8).reshape(-1, size) for c in sample["chunks"].to_pylist()]
    return train(chunks, sample["_label"].to_numpy().astype(np.float32))


def score(network: Network) -> Callable[[Column], Column]:
    """A column function: probability of label 1 of each whole text; a null text counts as empty."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(network.scores(texts.to_pylist()), pa.float64())

    return lambda text: scored(F.coalesce(text, F.lit("")).cast("binary"))
