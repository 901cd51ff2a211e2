import random
import re


from pressroom import fixed_values as V
from pressroom.functions.text import curate, measure, with_clean_text, with_spam_score


def cleaned(spark, *texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    rows = with_clean_text(df, "text", "out", **options).orderBy("i").collect()
    return [row["out"] for row in rows]


def test_cleaning_edges(spark):
    assert cleaned(
        spark,
        None,
        "",
        " a\n\nb\tc ",
        "Café — naïve “quoted” straße",
        "Ã©tÃ© and itâ€™s",
        "nice 😀❤️ 日本",
        "see https://a.example/x?y=1 or www.b.example now",
        "call 555-123-4567 555-765-4321, id 12345678901234",
        "a\x00b\x1b[31mc",
        "mail me at a.b@c.example",
    ) == [
        None,
        "",
        "a b c",
        'Cafe -- naive "quoted" strasse',
        "ete and it's",
        "nice 😀❤️ 日本",
        "see <URL> or <URL> now",
        "call <PHONE> <PHONE>, id 12345678901234",
        "abc",
        "mail me at a.b@c.example",
    ]


def test_hard_rows_neither_fail_nor_stall(spark):
    marks = "\u2764\ufe0f" * 500_000
    assert cleaned(spark, marks, "price à€€ today", "í€€ ð€€€ x", "HTTPS://A.Example/x WWW.b.example") == [
        marks,
        "price aEUREUR today",
        "iEUREUR dEUREUREUR x",
        "<URL> <URL>",
    ]


def test_optional_cleaning(spark):
    assert cleaned(spark, "mail a.b@c.example 3.5 times!", no_emails=True, no_numbers=True) == [
        "mail <EMAIL> <NUMBER> times!"
    ]
    assert cleaned(spark, "stop, now!", no_punct=True) == ["stop now"]


def test_counts(spark):
    df = spark.createDataFrame([("don't stop 12345 ünder_score",), (None,)], "t string")
    first, second = measure(df, "t").collect()
    assert (first["t_word_count"], first["t_token_count"]) == (5, 11)
    assert (second["t_word_count"], second["t_token_count"]) == (None, None)


EMOJI = {
    chr(c)
    for entry in V.EMOJI_CODE_POINTS
    for c in range(int(entry.split("-")[0], 16), int(entry.split("-")[-1], 16) + 1)
}


def spam_model(text):
    bare = text.lower().translate(str.maketrans("", "", V.ASCII_PUNCTUATION.replace("!", "")))
    words = [w for w in re.findall(r"\w+", bare) if w not in set(V.STOP_WORDS)]
    total = max(len(words), 1)
    shares = [
        (sum(c in EMOJI for c in text), 0.1),
        (sum(w in set(V.PROMO_WORDS) for w in words), 0.25),
        (len(re.findall(r"!{2,}", text)), 0.05),
    ]
    return min(sum(min(n / (total * w), 1.0) for n, w in shares) / 2, 1.0)


def test_spam_score_against_model(spark):
    rng = random.Random(7)
    pieces = V.PROMO_WORDS + V.STOP_WORDS[:40] + [
        "market", "bitcoin", "été", "risk-free", "free!!", "!!!", "😀", "©", "don't", "100%", "a_b", "3.5",
    ]
    texts = [" ".join(rng.choices(pieces, k=rng.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for row in with_spam_score(df, "text").collect():
        assert abs(row["spam_score"] - spam_model(row["text"])) < 1e-9, row["text"]


def test_spam_edges(spark):
    df = spark.createDataFrame([("100% risk-free",), ("free!!",), ("the of",), (None,)], "text string")
    assert [r["spam_score"] for r in with_spam_score(df, "text").collect()] == [0.0, 1.0, 0.0, None]


def test_curation(spark):
    plain = " ".join(["word"] * 99)
    at_limit = " ".join(["free"] * 13 + ["word"] * 91)
    rows = [
        (0, None, "404"),
        (1, plain, None),
        (2, plain + " word", "kept"),
        (3, " ".join(["free"] * 30 + ["word"] * 80), None),
        (4, "free!! 😀", None),
        (5, at_limit, None),
    ]
    out = curate(spark.createDataFrame(rows, "i int, text string, error string"), "text")
    out = {r["i"]: (r["text"] is not None, r["error"], r["spam_score"]) for r in out.collect()}
    assert out[0] == (False, "404", None)
    assert out[1] == (False, "text too short", None)
    assert out[2] == (True, "kept", 0.0)
    assert out[3][:2] == (False, "high spam score") and out[3][2] > 0.25
    assert out[4] == (False, "text too short", None)
    # 13 of 104 words at weight 0.25 give exactly a quarter: not above the limit.
    assert out[5] == (True, None, 0.25)


def test_no_letter_is_lost(spark):
    cases = {
        "Chapter Ⅳ costs ⅔ of № 5 at 20℃ ‥ end ＡＢＣ": "Chapter IV costs 2/3 of No 5 at 20dC .. end ABC",
        "Биткоин растёт Ελλάδα 比特币 ok": "Bitkoin rastet Ellada 比特币 ok",
        "한국 ひらがな カタカナ ﬁn Щука й": "hangug hiragana katakana fin Shchuka i",
        "हिन्दी العربية ①": "हिन्दी العربية 1",
        "e\u0301te\u0301 №№ \u200b\ue000x": "ete NoNo x",
        "т" * 100_000: "t" * 100_000,
    }
    assert cleaned(spark, *cases) == list(cases.values())


def test_runs_are_repaired_one_by_one(spark):
    assert cleaned(spark, "éÃ©é Ã¼ déjÃ\xa0 vu", "ÃƒÂ©", "Ð‘Ð¸Ñ‚ÐºÐ¾Ð¸Ð½ и æ¯”ç‰¹", "«É» ESPAÑ» Î» VUÉ»”", "Ã" * 50_000) == [
        "eee u deja vu", "e", "Bitkoin i 比特", '"E" ESPAN" I" VUE""', "A" * 50_000,
    ]


def test_ascii_rows_are_unchanged_by_cleaning_twice(spark):
    rows = ["Ünïcode  text\nhttps://x.example/a 555-123-4567", "plain"]
    once = cleaned(spark, *rows)
    assert cleaned(spark, *once) == once
