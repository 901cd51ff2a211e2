"""Learned sentence boundaries on hand-written rows."""

import random

from pressroom.operators import boundaries
from pressroom.session import stored

WORDS = "market price coin trader report week bank share rate index fund deal stock bond".split()


def corpus(rng):
    rows = []
    for i in range(120):
        sentences = []
        for _ in range(12):
            words = rng.choices(WORDS, k=6)
            words[2:2] = rng.choice([["Mr.", "Smith"], ["the", "U.S.", "stock"], ["J.", "Doe"], ["said"], ["in", "Jan.", "rain"]])
            sentences.append(rng.choice(["The ", "He ", "But "]) + " ".join(words) + rng.choice([".", ".", "!", "?"]))
        rows.append((i, sentences, "x"))
    return rows


def test_sentences_of_a_learned_corpus(spark):
    rows = corpus(random.Random(1))
    docs = spark.createDataFrame([(i, "  ".join(s), x) for i, s, x in rows], "id int, text string, pos string").repartition(5)
    learned = boundaries.learn(docs)
    found = {r["type"] for r in learned.abbreviations.collect()}
    assert {"mr", "u.s", "jan"} <= found and not found & set(WORDS)
    assert {r["type"] for r in learned.starters.collect()} == {"the", "he", "but"}
    assert ("mr", "smith") in {(r["type"], r["next_type"]) for r in learned.collocations.collect()}
    cut = boundaries.with_learned_sentences(docs, "id", learned)
    assert {r["id"]: r["sentences"] for r in cut.collect()} == {i: s for i, s, _ in rows}
    odd = [
        (1, None), (2, ""), (3, " \n "), (4, "He met Mr. Smith in the U.S. The end."), (5, 'He said "no." The end.'),
        (6, "It is no. 5. of ten. Wait... Then J. Doe left."), (7, "x" * 100_000 + ". The end"), (8, "." * 100_000 + " a" * 9),
        (9, "one. two. three"), (10, "A? B! (C.) D. "),
    ]
    cut = boundaries.with_learned_sentences(spark.createDataFrame(odd, "id int, text string"), "id", learned)
    got = {r["id"]: r["sentences"] for r in cut.collect()}
    assert got == {
        1: None, 2: [], 3: [], 4: ["He met Mr. Smith in the U.S.", "The end."], 5: ['He said "no."', "The end."],
        6: ["It is no.", "5. of ten.", "Wait...", "Then J. Doe left."], 7: ["x" * 100_000 + ".", "The end"],
        8: ["." * 100_000, "a a a a a a a a a"], 9: ["one.", "two.", "three"], 10: ["A?", "B!", "(C.) D."],
    }


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([], "id int, text string")
    learned = boundaries.learn(docs)
    assert [t.count() for t in (learned.abbreviations, learned.starters, learned.collocations)] == [0, 0, 0]
    one = spark.createDataFrame([(1, "Mr. Smith left. He slept.")], "id int, text string")
    assert boundaries.with_learned_sentences(one, "id", learned).first()["sentences"] == ["Mr.", "Smith left.", "He slept."]


def test_sure_ends_are_added_up_by_the_next_word(spark):
    """Sixty words end sentences here and three follow: pairs of both would grow with the vocabulary."""
    texts = [(i, f"The end{i}? He left w{i}! But she came b{i}? ") for i in range(20)]
    boundaries.learn(spark.createDataFrame([(i, t * 3) for i, t in texts], "id int, text string"))
    path = [p for _, p in stored() if "boundary-pairs" in p][-1]
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {
        (None, None, "the", 40), (None, None, "he", 60), (None, None, "but", 60)
    }


def test_boundaries_before_any_white_space(spark):
    texts = [(1, ' \t"A (b.)\n\f\'C d!\r?\n'), (2, "\n. x. \t"), (3, "J.\tDoe 5.\n\nNo... 7.5.  end. "), (4, None), (5, "no")]
    rows = boundaries.candidates(spark.createDataFrame(texts, "id int, text string"), ["id"], "text")
    assert sorted(tuple(r)[:6] for r in rows.collect()) == [
        (1, 0, "b", True, "initial", "c"), (1, 1, "d", False, None, ""), (1, 2, "", False, None, ""),
        (2, 0, "", True, None, "x"), (2, 1, "x", True, "initial", ""),
        (3, 0, "j", True, "initial", "doe"), (3, 1, "5", True, "number", "no"), (3, 2, "no", False, None, "7.5"),
        (3, 3, "7.5", True, "number", "end"),
    ]


def test_tokens_without_their_marks(spark):
    tokens = ['"(A.)"', '"""', ")(", "...", "U.S.", "a!.?", ".", "x..", "b.'", "“c.”", "É.", "y" * 65 + "."]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, t string")
    bare = rows.select("i", boundaries.core(rows.t).alias("b"))
    found = bare.select("b", boundaries.token_type(bare.b), boundaries.ends_in_period(bare.b)).orderBy("i").collect()
    assert [tuple(r) for r in found] == [
        ("A.", "a", True), ("", "", False), (")(", ")(", False), ("...", "", False), ("U.S.", "u.s", True),
        ("a!.?", "a", False), (".", "", True), ("x..", "x", False), ("b.", "b", True), ("“c.”", "“c.”", False),
        ("É.", "é", True), ("", "", False),
    ]
