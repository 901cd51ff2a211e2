"""Row medians and neighbourhood means of a document's sentence similarities.

The only Python in the library. A document's n x n similarity matrix is needed for exact row
medians, but neither as rows of a table nor as a whole: the helpers below work inside the
document's own row and hold one matrix row, or one block of rows, at a time. Spark's part is to
spread the documents over tasks.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from pressroom.fixed_values import LOCAL_WINDOW

# The helpers travel to the executors inside the function, so that no package has to be there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCK_CELLS = 4_000_000
RESULT = T.StructType(
    [T.StructField(name, T.ArrayType(T.DoubleType())) for name in ("median", "local")]
)


def _row_scores(row_blocks, weights):
    """Weighted median and local mean per row, from blocks of consecutive similarity rows."""
    n = len(weights)
    radius = min(LOCAL_WINDOW, n - 1)
    medians, local = np.zeros(n), np.zeros(n)
    start = 0
    for block in row_blocks:
        rows = np.arange(start, start + len(block))
        medians[rows] = np.median(block, axis=1) * weights[rows]
        total, count = np.zeros(len(rows)), np.zeros(len(rows))
        for step in [s for s in range(-radius, radius + 1) if s]:
            inside = (rows + step >= 0) & (rows + step < n)
            total[inside] += block[inside, rows[inside] + step]
            count += inside
        local[rows] = total * weights[rows] / np.maximum(count, 1)
        start += len(block)
    return medians, local


def dense_blocks(vectors):
    """Cosine similarity of dense vectors, in blocks of rows."""
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.where(norms > 0, norms, 1.0)
    step = max(1, _BLOCK_CELLS // max(len(unit), 1))
    for start in range(0, len(unit), step):
        yield unit[start : start + step] @ unit.T


def tfidf_blocks(codes, bounds):
    """Cosine similarity of sentences given as term codes, in blocks of rows.

    Weight = term frequency in the sentence x smoothed inverse sentence frequency in the
    document. ``bounds`` marks where each sentence's codes begin. Terms of a single sentence
    count for its length only, and the others are laid out a slice of the vocabulary at a time,
    so that memory stays bounded for any document.
    """
    n = len(bounds) - 1
    sentence = np.repeat(np.arange(n), np.diff(bounds))
    terms, codes = np.unique(codes, return_inverse=True)
    width = max(len(terms), 1)
    cells, frequency = np.unique(sentence * width + codes, return_counts=True)
    sentence, codes = np.divmod(cells, width)
    spread = np.bincount(codes, minlength=width)
    weight = frequency * (np.log((1.0 + n) / (1.0 + spread[codes])) + 1.0)
    norms = np.sqrt(np.bincount(sentence, weights=weight * weight, minlength=n))
    weight = weight / norms[sentence]
    shared = spread[codes] > 1
    terms, codes = np.unique(codes[shared], return_inverse=True)
    sentence, weight = sentence[shared], weight[shared]

    step = max(1, _BLOCK_CELLS // max(n, 1))

    def vocabulary_slice(first):
        inside = (codes >= first) & (codes < first + step)
        laid_out = np.zeros((n, min(step, len(terms) - first)))
        laid_out[sentence[inside], codes[inside] - first] = weight[inside]
        return laid_out

    whole = vocabulary_slice(0) if len(terms) <= step else None
    for start in range(0, n, step):
        rows = np.arange(start, min(start + step, n))
        block = np.zeros((len(rows), n))
        for first in range(0, len(terms), step):
            part = vocabulary_slice(first) if whole is None else whole
            block += part[rows] @ part.T
        block[np.arange(len(rows)), rows] = norms[rows] > 0
        yield block


def _offsets(lists: pa.ListArray) -> np.ndarray:
    return lists.offsets.to_numpy()


def _score_documents(blocks_of, documents: pa.ListArray, weights: pa.ListArray) -> pa.Array:
    outer, weight_at = _offsets(documents), _offsets(weights)
    weight_values = weights.values.to_numpy(zero_copy_only=False)
    results = []
    for row in range(len(documents)):
        if not (documents[row].is_valid and weights[row].is_valid):
            results.append(None)
            continue
        own = weight_values[weight_at[row] : weight_at[row + 1]]
        median, local = _row_scores(blocks_of(outer[row], outer[row + 1]), own)
        results.append({"median": median, "local": local})
    value = pa.list_(pa.float64())
    return pa.array(results, type=pa.struct([("median", value), ("local", value)]))


@arrow_udf(RESULT)
def tfidf_row_scores(terms: pa.Array, weights: pa.Array) -> pa.Array:
    """``terms``: words of each sentence of a document; ``weights``: length weight of each."""
    inner = terms.values
    bounds = _offsets(inner)
    codes = inner.values.dictionary_encode().indices.to_numpy(zero_copy_only=False)

    def blocks_of(begin, end):
        own = bounds[begin : end + 1]
        return tfidf_blocks(codes[own[0] : own[-1]], own - own[0])

    return _score_documents(blocks_of, terms, weights)


@arrow_udf(RESULT)
def dense_row_scores(vectors: pa.Array, weights: pa.Array) -> pa.Array:
    """``vectors``: embedding of each sentence of a document; ``weights``: length weight of each."""
    inner = vectors.values
    bounds = _offsets(inner)
    values = inner.values.to_numpy(zero_copy_only=False).astype(np.float64)

    def blocks_of(begin, end):
        own = values[bounds[begin] : bounds[end]]
        return dense_blocks(own.reshape(end - begin, -1))

    return _score_documents(blocks_of, vectors, weights)
