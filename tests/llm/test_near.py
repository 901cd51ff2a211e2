"""Similarity joins, components and fingerprints against brute force."""

import itertools
import random

import numpy as np

from pressroom.llm import embeddings, jaccard, sketch
from pressroom.llm.components import components
from pressroom.llm.textkit import shingles, word_hashes


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def near_documents(seed=3):
    """Groups of edited copies with similarities on both sides of 0.8, exact copies, shared passages."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    rows = []
    for group in range(12):
        base = words(rng, 120)
        for copy in range(6):
            text = list(base)
            for _ in range(copy):
                text[rng.randrange(len(text))] = f"edit{rng.randrange(10**6)}"
            rows.append((" ".join(text), "a"))
            if copy == 2:
                rows.append((" ".join(text).upper() + "!", "a"))
    rows += [(" ".join(words(rng, 50) + passage), "b") for _ in range(60)]
    rows += [("", "c"), (None, "c"), ("... !!", "c"), ("one two", "c"), ("One, two.", "c"), ("word " * 4000, "c")]
    return [(i * 3 + 1, t, s) for i, (t, s) in enumerate(rows)]


def brute_classes(rows, threshold=0.8):
    sets = {i: set(shingles(t).tolist()) for i, t, _ in rows}
    links = {i: 0 for i in sets}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        union = len(sets[a] | sets[b])
        if union and sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * union:
            links[a] += 1
            links[b] += 1
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (find(i), links[i]) for i in sets}


def test_jaccard_classes_equal_brute_force(documents):
    rows = near_documents()
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard.jaccard_classes(documents(rows)).collect()}
    assert found == brute_classes(rows)


def test_jaccard_with_tiny_buckets_and_blocks_loses_nothing(documents):
    """Splits, paths below paths and block pairs are all taken, with the same result."""
    rows = near_documents(5)
    result = jaccard.jaccard_classes(documents(rows), bucket=4, depth=2, block=3)
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in result.collect()} == brute_classes(rows)


def test_jaccard_edges(documents):
    assert jaccard.jaccard_classes(documents([])).collect() == []
    text = "alpha beta gamma delta epsilon zeta"
    rows = jaccard.jaccard_classes(documents([(None, text, None), (7, text, None), (7, text, None), (9, text, None)]))
    found = [(r["doc_id"] or 0, r["class_id"], r["n_links"], r["kept"]) for r in rows.collect()]
    assert sorted(found) == [(0, 7, 3, False), (7, 7, 3, True), (7, 7, 3, True), (9, 7, 3, False)]


def test_jaccard_tells_rows_of_one_id_apart(session, documents, tmp_path):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    rows = [(7, a, None), (7, b, None), (8, a, None), (9, b, None), (None, c, None), (None, c, None), (None, "other words", None)]
    documents(rows).repartition(3).write.parquet(str(tmp_path / "docs"))
    for docs in (documents(rows), session.read.parquet(str(tmp_path / "docs"))):
        found = sorted((r["doc_id"] or 0, r["class_id"] or 0, r["n_links"], r["kept"]) for r in jaccard.jaccard_classes(docs).collect())
        assert found[:3] == [(0, 0, 0, True), (0, 0, 1, False), (0, 0, 1, True)]
        assert found[3:] == [(7, 7, 1, True), (7, 7, 1, True), (8, 7, 1, False), (9, 7, 1, False)]


def test_words_and_shingles():
    assert len(word_hashes("A b, a_B  é—ü 12")) == 5
    assert (word_hashes("One two")[0], len(shingles("One two"))) == (word_hashes("one")[0], 1)
    assert len(shingles(None)) == 0
    long = " ".join(f"x{i}" for i in range(300_000))
    parts = np.concatenate([word_hashes(" ".join(f"x{i}" for i in range(k, k + 1000))) for k in range(0, 300_000, 1000)])
    assert (word_hashes(long) == parts).all()


def test_components_of_chains_stars_and_loops(session):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(7, 7), (None, 3), (260, 9)]
    rng.shuffle(edges)
    found = {r["node"]: r["component"] for r in components(session.createDataFrame(edges, "a long, b long")).collect()}
    assert {found[i] for i in range(100, 161)} == {100}
    assert {found[i] for i in range(200, 260)} == {5}
    assert (found[7], found[260], 3 in found) == (7, 9, False)
    assert components(session.createDataFrame([], "a long, b long")).collect() == []


def vectors(dim=24):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(40):
        centre = rng.standard_normal(dim)
        for _ in range(5):
            rows.append((centre + rng.standard_normal(dim) * rng.choice([0.05, 0.3])).tolist())
    rows += [rows[0], rows[0], [x * 1e200 for x in rows[1]], [x * 1e-200 for x in rows[1]]]
    rows += [None, [0.0] * dim, [float("nan")] * dim, [None] + [1.0] * (dim - 1), [1.0] * 3, [], [float("inf")] * dim]
    rows += [[1.0, 1.0, 1.01], [2.0] * 3, [-1.0, 1.0, 1.0], [5.0]]
    return [(i * 2, v, 1, "x") for i, v in enumerate(rows)]


def brute_vectors(rows, threshold=0.9):
    usable = {i: np.array(v, float) for i, v, *_ in rows if v and None not in v}
    usable = {i: v for i, v in usable.items() if np.isfinite(v).all() and v.any()}
    unit = {i: v / abs(v).max() for i, v in usable.items()}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    pairs = itertools.combinations(unit, 2)
    return {(a, b) for a, b in pairs if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold}


def test_vector_classes_reach_recall_and_add_nothing(session):
    rows = vectors()
    spec = "vec_id long, embedding array<double>, label int, id string"
    found = embeddings.vector_classes(session.createDataFrame(rows, spec)).collect()
    pairs = brute_vectors(rows)
    degree = {i: sum(i in p for p in pairs) for i, *_ in rows}
    links = {r["vec_id"]: r["n_links"] for r in found}
    assert len(found) == len(rows)
    assert all(links[i] <= degree[i] for i in degree)
    assert sum(links.values()) >= 0.9 * sum(degree.values())
    small = embeddings.vector_classes(session.createDataFrame(rows, spec), bucket=4, block=3).collect()
    assert all(r["n_links"] <= degree[r["vec_id"]] for r in small)
    assert sum(r["n_links"] for r in small) >= 0.9 * sum(degree.values())


def test_vector_edges(session):
    spec = "vec_id long, embedding array<float>"
    assert embeddings.vector_classes(session.createDataFrame([], spec)).collect() == []
    eight, two = [float(i) for i in range(1, 9)], [-1.0, 1.0]
    rows = [(1, None), (2, [0.0, 0.0]), (None, two), (None, two), (3, [1.0, 2.0, 3.0]), (4, [1.0, 2.0, 3.01]), (5, [2.0, 4.0, 6.0])]
    rows += [(6, eight), (6, [-x for x in eight]), (7, [-x for x in eight]), (9, eight)]
    found = embeddings.vector_classes(session.createDataFrame(rows, spec)).collect()
    assert sorted((r["vec_id"] or 0, r["class_id"] or 0, r["n_links"], r["kept"]) for r in found) == [
        (0, 0, 1, False), (0, 0, 1, True), (1, 1, 0, True), (2, 2, 0, True), (3, 3, 2, True), (4, 3, 2, False),
        (5, 3, 2, False), (6, 6, 1, True), (6, 6, 1, True), (7, 6, 1, False), (9, 6, 1, False),
    ]


def test_rotation_balances_codes():
    unit = embeddings.unit_rows(np.random.default_rng(0).standard_normal((500, 16)))
    rotation = embeddings.learn_rotation(unit, 1)
    assert np.allclose(rotation @ rotation.T, np.eye(16), atol=1e-9)
    assert abs(((unit @ rotation) >= 0).mean() - 0.5) < 0.05


def test_sketch_estimates_and_merges():
    rng = random.Random(4)
    a = [f"t{rng.randrange(10**9)}" for _ in range(3000)]
    b = a[:2000] + [f"t{rng.randrange(10**9)}" for _ in range(1000)]
    one, two = (sketch.bottom_k(" ".join(x)) for x in (a, b))
    sets = [set(shingles(" ".join(x)).tolist()) for x in (a, b)]
    true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    assert abs(sketch.resemblance(one, two) - true) < 0.15
    assert abs(sketch.containment(one, two) - len(sets[0] & sets[1]) / len(sets[0])) < 0.2
    assert abs(sketch.distinct_count(one) / len(sets[0]) - 1) < 0.3
    assert (sketch.from_text(sketch.to_text(one)) == one).all()
    both = np.unique(np.concatenate([shingles(" ".join(a)), shingles(" ".join(b))]))
    assert (sketch.merge([one, two]) == (both >> np.uint64(16))[: sketch.K]).all()
    assert sketch.resemblance(sketch.bottom_k(""), sketch.bottom_k(None)) == 1.0


def test_merged_fingerprints_equal_those_of_all_parts(session, documents):
    rng = random.Random(6)
    rows = [(i, " ".join(words(rng, 90)), "s" if i % 3 else "t") for i in range(30)] + [(99, None, "empty")]
    parts = sketch.fingerprints(documents(rows))
    found = {r["source"]: r for r in sketch.merged_fingerprints(parts, ["source"]).collect()}
    for source in ("s", "t"):
        whole = sketch.merge([sketch.bottom_k(t) for _, t, s in rows if s == source])
        assert found[source]["fingerprint"] == sketch.to_text(whole)
        assert abs(found[source]["distinct_shingles"] - sketch.distinct_count(whole)) < 1e-6
    assert (found["empty"]["fingerprint"], found["empty"]["distinct_shingles"]) == ("", 0.0)


def test_edited_fingerprints_follow_the_order_of_ids(documents):
    import hashlib

    rng = random.Random(8)
    rows = [(i * 7, " ".join(words(rng, rng.randrange(0, 60))) + "é😀", None) for i in range(60)]
    rows += [(1000, None, None), (1001, "", None), (1002, "x" * 400_000, None), (None, "no id", None)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    found = {r["doc_id"]: r for r in sketch.edited_fingerprints(documents(shuffled), parts=7).collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for at, (key, text, _) in enumerate(ordered):
        text, after = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        row = found[key]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert row["fingerprint"] == sketch.to_text(sketch.bottom_k(text))
        assert row["near_next"] == sketch.resemblance(sketch.bottom_k(text), sketch.bottom_k(after))
    lone = sketch.edited_fingerprints(documents([(5, "abcd efgh", None)])).collect()
    assert lone[0]["edited_sha256"] == hashlib.sha256(b"abcd efab").hexdigest()
    assert sketch.edited_fingerprints(documents([])).collect() == []
