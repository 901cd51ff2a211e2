"""Toxicity grades by cumulative-link ordinal regression on sparse text features."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.common import give_back, save
from pressroom.llm.textkit import folded, pieces_of, span_hashes, word_spans

#: Grades are 0 (not toxic) to GRADES - 1.
GRADES = 4
#: Labelled rows of each class that a fit takes at most, and features that it keeps at most.
PER_CLASS = 5_000
MAX_FEATURES = 20_000
#: A feature is kept if its share is higher among toxic texts by so many standard errors, in so many
#: texts, and so many times as high; what is merely common in some language or length stays out.
MIN_Z, MIN_DOCS, MIN_LIFT = 4.5, 5, 3.0
#: Words also stand for their beginnings of so many bytes, which inflected words share.
PREFIXES = (5, 7)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of the whole text's words and word beginnings, and their counts."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    parts = []
    for piece in pieces_of(folded(text)):
        array, starts, ends = word_spans(piece)
        parts.append(span_hashes(array, starts, ends))
        for n in PREFIXES:
            long = ends - starts > n
            parts.append(span_hashes(array, starts[long], starts[long] + n) + np.uint64(n))
    return np.unique(np.concatenate(parts), return_counts=True)


@dataclass
class Ordinal:
    """One weight per feature, shared by all thresholds, and the ordered thresholds."""

    keys: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # GRADES - 1, ascending

    def __post_init__(self):
        self.mask = np.zeros(1 << 20, bool)
        self.mask[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def known(self, keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which features of a text the model has, and how often they occur."""
        maybe = np.flatnonzero(self.mask[(keys >> np.uint64(44)).astype(np.int64)])
        at = np.searchsorted(self.keys, keys[maybe])
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == keys[maybe] if len(self.keys) else np.zeros(len(at), bool)
        return at[hit], counts[maybe[hit]]

    def exceed(self, texts: list[str | None]) -> np.ndarray:
        """Probability, per text and threshold, of a grade above it."""
        value = np.zeros(len(texts))
        for i, text in enumerate(texts):
            at, n = self.known(*features(text))
            value[i] = self.weights[at] @ np.log2(1 + n)
        return 1 / (1 + np.exp(-np.clip(value[:, None] - self.thresholds[None, :], -40, 40)))


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, size: int, levels: int = GRADES, rounds: int = 400):
    """Weights and thresholds by Adam on the cumulative likelihood, with a small quadratic penalty."""
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    column = np.concatenate([r[0] for r in rows] + [np.empty(0, np.int64)]).astype(np.int64)
    value = np.log2(1 + np.concatenate([r[1] for r in rows] + [np.empty(0)]).astype(np.float64))
    row = np.arange(len(rows))
    params = np.concatenate([np.zeros(size), [1.0], np.zeros(levels - 2)])
    first, second = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        weights, low, gaps = params[:size], params[size], np.exp(params[size + 1 :])
        thresholds = low + np.concatenate([[0.0], np.cumsum(gaps)])
        score = np.bincount(owner, value * weights[column], minlength=len(rows))
        passed = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds[None, :], -40, 40)))
        passed = np.concatenate([np.ones((len(rows), 1)), passed, np.zeros((len(rows), 1))], axis=1)
        low_side, high_side = passed[row, grades], passed[row, grades + 1]
        chance = np.maximum(low_side - high_side, 1e-12) * len(rows)
        gradient = np.empty_like(params)
        by_row = (low_side + high_side - 1) / len(rows)
        gradient[:size] = np.bincount(column, value * by_row[owner], minlength=size) + 2e-4 * weights
        edge = np.bincount(grades, low_side * (1 - low_side) / chance, minlength=levels)[1:]
        by_threshold = edge - np.bincount(grades, high_side * (1 - high_side) / chance, minlength=levels)[:-1]
        gradient[size] = by_threshold.sum()
        gradient[size + 1 :] = np.cumsum(by_threshold[::-1])[::-1][1:] * gaps
        first += 0.1 * (gradient - first)
        second += 0.001 * (gradient * gradient - second)
        params -= 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    gaps = np.exp(params[size + 1 :])
    return params[:size].copy(), params[size] + np.concatenate([[0.0], np.cumsum(gaps)])


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    label_col: str = "toxic", per_class: int = PER_CLASS,
) -> Ordinal:
    """A model learned from at most ``per_class`` labelled rows of each class, the first by a hash of their id.

    Labels say toxic or not; the grade of a toxic text, 1 to 3, is the third in which its score
    by a first fit to the labels lies among the toxic texts of the sample. Features are counted with a grouped
    aggregation, and those of toxic texts are kept. Rows with a null id or label
    are passed over. Without both classes nothing is toxic.
    """
    usable = labels.select(F.col(id_col), F.col(label_col).cast("int").alias("_label"))
    picked = None
    for value in (0, 1):
        part = usable.filter(F.col("_label") == value).orderBy(F.xxhash64(id_col), id_col).limit(per_class)
        picked = part if picked is None else picked.union(part)
    # A broadcast of at most 2 * per_class rows of two numbers.
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    sample = save(rows.join(F.broadcast(picked), id_col).select(id_col, "_label", "_text"), "sample")

    @F.arrow_udf("array<long>")
    def keys_of(texts: pa.Array) -> pa.Array:
        give_back()
        return pa.array([features(t)[0].view(np.int64) for t in texts.to_pylist()], pa.list_(pa.int64()))

    sizes = dict(sample.groupBy("_label").count().collect())
    none = Ordinal(np.empty(0, np.uint64), np.empty(0), np.full(GRADES - 1, 20.0))
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return none
    each = sample.select("_label", F.explode(keys_of("_text")).alias("key"))
    counts = each.groupBy("key").agg(F.sum("_label").alias("t"), F.count(F.lit(1)).alias("n"))
    share = F.col("n") / (toxic + clean)
    error = F.sqrt(share * (1 - share) * (1 / toxic + 1 / clean))
    z = (F.col("t") / toxic - (F.col("n") - F.col("t")) / clean) / F.greatest(error, F.lit(1e-9))
    lift = F.col("t") / toxic >= MIN_LIFT * (F.col("n") - F.col("t")) / clean
    kept = counts.withColumn("z", z).filter((F.col("n") >= MIN_DOCS) & (F.col("z") >= MIN_Z) & lift)
    kept = kept.orderBy(F.desc("z"), "key").limit(MAX_FEATURES).select("key").toArrow()
    keys = np.sort(kept["key"].to_numpy().view(np.uint64))
    blank = Ordinal(keys, np.zeros(len(keys)), np.zeros(GRADES - 1))

    @F.arrow_udf("struct<at:array<int>,n:array<long>>")
    def known(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            at, n = blank.known(*features(t))
            out.append({"at": at.tolist(), "n": n.tolist()})
        kind = pa.struct([("at", pa.list_(pa.int32())), ("n", pa.list_(pa.int64()))])
        return pa.array(out, kind)

    table = sample.select("_label", id_col, known("_text").alias("k")).toArrow().sort_by([(id_col, "ascending")])
    found = [(np.array(k["at"], np.int64), np.array(k["n"], np.int64)) for k in table["k"].to_pylist()]
    label = table["_label"].to_numpy()
    weights, thresholds = fit_ordinal(found, label, len(keys), levels=2)
    first = np.array([weights[at] @ np.log2(1 + n) for at, n in found])
    marks = np.quantile(first[label == 1], np.arange(1, GRADES - 1) / (GRADES - 1))
    grades = np.where(label == 1, 1 + np.searchsorted(marks, first, side="right"), 0)
    weights, thresholds = fit_ordinal(found, grades, len(keys))
    return Ordinal(keys, weights, thresholds)


def grade(model: Ordinal) -> Callable[[Column], Column]:
    """A column function: ``struct(severity, p_toxic, grade)`` of each whole text.

    ``severity`` is the expected grade, 0 to ``GRADES - 1``; ``grade`` the number of thresholds that
    are exceeded with probability 0.5 or more. A null or empty text has no features.
    """

    @F.arrow_udf("struct<severity:double,p_toxic:double,grade:int>")
    def graded(texts: pa.Array) -> pa.Array:
        give_back()
        p = model.exceed(texts.to_pylist())
        columns = [pa.array(p.sum(axis=1)), pa.array(p[:, 0]), pa.array((p >= 0.5).sum(axis=1).astype(np.int32))]
        return pa.StructArray.from_arrays(columns, ["severity", "p_toxic", "grade"])

    return lambda text: graded(F.coalesce(text, F.lit("")))
