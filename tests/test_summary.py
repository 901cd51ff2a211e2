import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pressroom import fixed_values as V
from pressroom.functions import sentences as S
from pressroom.functions import similarity
from pressroom.functions.summary import with_centrality, with_summary

STOP = {w for w in V.STOP_WORDS if "'" not in w}


def count_tokens(text):
    return len(re.findall(r"[^\W\d_]{1,4}|\d{1,3}|[^\s\w]|_", text))


def model_similarity(sentences):
    terms = [[w for w in re.findall(r"\w+", s.lower()) if w not in STOP] for s in sentences]
    names = sorted({w for t in terms for w in t})
    n = len(sentences)
    spread = {w: sum(w in t for t in terms) for w in names}
    matrix = np.array(
        [[t.count(w) * (np.log((1 + n) / (1 + spread[w])) + 1) for w in names] for t in terms]
    ).reshape(n, len(names))
    norm = np.linalg.norm(matrix, axis=1, keepdims=True)
    unit = matrix / np.where(norm > 0, norm, 1)
    return unit @ unit.T


def model_centrality(sim, n_words):
    n = len(n_words)
    weight = np.minimum(np.array(n_words) / np.quantile(n_words, 0.9), 1)
    weighted = sim * weight[:, None]
    near = []
    for i in range(n):
        around = [j for j in range(i - 3, i + 4) if 0 <= j < n and j != i]
        near.append(weighted[i, around].mean())

    def scale(x):
        return (x - x.min()) / (x.max() - x.min() + 1e-8)

    return 0.7 * scale(np.median(weighted, axis=1)) + 0.3 * scale(np.array(near))


def model_summary(text, budget, compat=False):
    if count_tokens(text) < budget:
        return text
    sentences = re.sub(r"([.!?])\s+", "\\1\x01", text.strip()).split("\x01")
    n = len(sentences)
    if n < 3:
        return None
    score = 0.75 * model_centrality(model_similarity(sentences), [len(s.split()) for s in sentences])
    if n > 3:
        score[:3] += 0.2 * np.array([1.0, 0.75, 0.5])
    if n >= 5:
        score[-2:] += 0.05 * np.array([0.5, 1.0])
    order = sorted(range(n), key=lambda i: (round(score[i], 9), i), reverse=True)
    kept, total = [], 0
    for i in order:
        total += count_tokens(sentences[i])
        if total > budget:
            break
        kept.append(i)
    if compat and len(kept) == n:
        kept.pop()
    summary = " ".join(sentences[i] for i in sorted(kept))
    return summary if compat or summary else None


def random_text(rng, n):
    words = ["bitcoin", "market", "the", "price", "of", "rose", "fund", "bank", "rules", "token", "été"]
    return " ".join(
        " ".join(rng.choices(words, k=rng.randint(1, 12))) + rng.choice(".!?") for _ in range(n)
    )


@pytest.mark.parametrize("compat", [False, True])
def test_summary_against_model(spark, compat):
    rng = random.Random(3)
    texts = [random_text(rng, n) for n in [1, 2, 3, 4, 5, 6, 9, 20, 40, 60] for _ in range(4)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    out = with_summary(df, "text", "summary", max_tokens=60, compat=compat)
    for row in out.collect():
        assert row["summary"] == model_summary(row["text"], 60, compat), row["text"]


def test_summary_edges(spark):
    long_sentence = "word " * 1200
    rows = [
        (0, None),
        (1, "a " * 999),
        (2, long_sentence + ". Two."),
        (3, ". ".join([long_sentence] * 3) + "."),
    ]
    df = spark.createDataFrame(rows, "i int, text string")
    out = {r["i"]: r["s"] for r in with_summary(df, "text", "s").collect()}
    assert out == {0: None, 1: "a " * 999, 2: None, 3: None}
    compat = {r["i"]: r["s"] for r in with_summary(df, "text", "s", compat=True).collect()}
    assert compat[3] == ""


def test_summary_sentences_keep_their_order_and_budget(spark):
    rng = random.Random(5)
    texts = [random_text(rng, 400) for _ in range(5)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in with_summary(df, "text", "s").collect():
        source = re.sub(r"([.!?])\s+", "\\1\x01", row["text"]).split("\x01")
        at = 0
        for sentence in re.sub(r"([.!?])\s+", "\\1\x01", row["s"]).split("\x01"):
            at = source.index(sentence, at) + 1
        assert count_tokens(row["s"]) <= 1000


def test_supplied_embedding(spark):
    df = spark.createDataFrame([("One two three. " * 200,)], "text string")

    def embed(sentences):
        return F.transform(sentences, lambda s: F.array(F.length(s).cast("double"), F.lit(1.0)))

    assert with_summary(df, "text", "s", embed=embed).first()["s"]


def test_dense_centrality_against_model(spark):
    rng = np.random.default_rng(1)
    docs = [(n, rng.normal(size=(n, 5)).tolist(), rng.integers(1, 9, n).tolist()) for n in (2, 3, 8, 50)]
    df = spark.createDataFrame(docs, "n int, vectors array<array<double>>, n_words array<int>")
    for row in with_centrality(df, "n_words", vectors="vectors").collect():
        x = np.array(row["vectors"])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        assert np.allclose(row["centrality"], model_centrality(x @ x.T, row["n_words"]))


def test_blocks_do_not_change_the_scores(monkeypatch):
    rng = np.random.default_rng(2)
    bounds = np.concatenate([[0], np.cumsum(rng.integers(0, 6, 30))])
    codes = rng.integers(0, 12, bounds[-1])
    weights = rng.random(30)
    whole = similarity._row_scores(similarity.tfidf_blocks(codes, bounds), weights)
    monkeypatch.setattr(similarity, "_BLOCK_CELLS", 70)
    cut = similarity._row_scores(similarity.tfidf_blocks(codes, bounds), weights)
    assert np.allclose(whole, cut)


def test_quantile_and_positions(spark):
    df = spark.createDataFrame([([5],), ([1, 2, 3, 10],)], "v array<int>")
    got = [r[0] for r in df.select(S.array_quantile(F.col("v"), 0.9)).collect()]
    assert np.allclose(got, [5, np.quantile([1, 2, 3, 10], 0.9)])
    rows = spark.createDataFrame([(n, i) for n in (3, 4, 5) for i in range(n)], "n int, i int")
    intro, conclusion = S.position_scores(F.col("n"), F.col("i"))
    got = {(r[0], r[1]): (r[2], r[3]) for r in rows.select("n", "i", intro, conclusion).collect()}
    assert all(got[(3, i)] == (0, 0) for i in range(3))
    assert [got[(4, i)] for i in range(4)] == [(1, 0), (0.75, 0), (0.5, 0), (0, 0)]
    assert [got[(5, i)] for i in range(5)] == [(1, 0), (0.75, 0), (0.5, 0), (0, 0.5), (0, 1)]


def test_python_token_counter(spark):
    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else len(t.split())).astype("Int64")

    @F.pandas_udf("array<int>")
    def count_all(lists: pd.Series) -> pd.Series:
        return lists.map(lambda ss: None if ss is None else [len(s.split()) for s in ss])

    df = spark.createDataFrame([("One two three. " * 200,), ("Short.",)], "text string")
    out = with_summary(df, "text", "s", max_tokens=60, token_counter=count, sentence_counter=count_all)
    assert [len(r["s"].split()) for r in out.collect()] == [60, 1]
