import json

import pytest
from pyspark.sql import functions as F

from pressroom import fixed_values as V
from pressroom.operators import analysis
from pressroom.plans.analysis import pending_requests, store_responses
from pressroom.sources.analysis import read_responses, write_requests
from pressroom.sources.tables import Warehouse

GOOD = {
    "news_id": "1", "emotion_category": "Fearful", "event_category": ["Market"],
    "price_direction_category": "Upward", "timeframe_category": "long-term",
    **{name: 0.25 for name in V.REQUIRED_SCORES}, "neutral": 0.5,
    "key_topics": ["k"], "free_text_summary": "s", "historical_analogy": None,
}


def variant(news_id, drop=None, **change):
    result = {**GOOD, "news_id": news_id, **change}
    result.pop(drop, None)
    return result


def parse(spark, *texts, **options):
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "batch_id string, response_json string")
    return analysis.parse_responses(df, **options)


def test_validation(spark):
    items = [
        variant("good"),
        variant("quoted", **{name: "0.3" for name in V.REQUIRED_SCORES}),
        variant("emotion", emotion_category="Angry"),
        variant("range", confidence_score=1.2),
        variant("missing", drop="virality_score"),
        variant("event", event_category=["Market", "Gossip"]),
        variant("sum", neutral=0.1),
        variant("alternative", drop="free_text_summary", summary="other spelling", reasoning="why"),
        variant("optional", fud_score=7),
        variant("text", positive="high"),
    ]
    rows = {r["news_id"]: r for r in parse(spark, json.dumps(items)).collect()}
    problems = {name: row["problems"] for name, row in rows.items()}
    assert problems == {
        "good": [],
        "quoted": [],
        "emotion": ["invalid emotion_category"],
        "range": ["invalid confidence_score"],
        "missing": ["missing virality_score"],
        "event": ["invalid event_category"],
        "sum": [],
        "alternative": [],
        "optional": ["invalid fud_score"],
        "text": ["invalid positive"],
    }
    assert rows["sum"]["sentiment_warning"] and not rows["good"]["sentiment_warning"]
    assert rows["quoted"]["positive"] == 0.3
    assert rows["alternative"]["free_text_summary"] == "other spelling"
    assert rows["alternative"]["explain_reasoning_summary"] == "why"


def test_unreadable_responses(spark):
    good = json.dumps([variant("1")])
    parsed = parse(spark, good, good[:-10], "7", "", "[]")
    rejected = {r["batch_id"]: r["reason"] for r in analysis.rejected_responses(parsed).collect()}
    assert rejected == {"1": "invalid JSON", "2": "invalid JSON", "3": "invalid JSON"}
    assert [r["news_id"] for r in analysis.valid_responses(parsed).collect()] == ["1"]


def test_strict_mode_fails_the_batch(spark):
    assert parse(spark, json.dumps([variant("1")]), strict=True).count() == 1
    with pytest.raises(Exception, match="Invalid response format: invalid emotion_category"):
        parse(spark, json.dumps([variant("1", emotion_category="Angry")]), strict=True).collect()


def test_single_answers(spark):
    df = spark.createDataFrame([(json.dumps(GOOD),), ("",), (None,), ("{",)], "content string")
    got = [(r["decode_error"], r["item"] and r["item"]["news_id"]) for r in analysis.decode_single(df).collect()]
    assert got == [
        (None, "1"),
        ("Empty response from API", None),
        ("Empty response from API", None),
        ("API response is not valid JSON", None),
    ]


def test_messages_and_requests(spark, tmp_path):
    df = spark.createDataFrame([("7", "A title", 'Text "quoted"'), ("8", None, "t")], "news_id string, title_text string, llm_ready_text string")
    requests = analysis.batch_requests(df)
    write_requests(requests, str(tmp_path / "out"))
    lines = [json.loads(r[0]) for r in spark.read.text(str(tmp_path / "out")).collect()]
    first = next(line for line in lines if line["custom_id"] == "article_7")
    assert first["method"] == "POST" and first["url"] == "/v1/chat/completions"
    assert {k: first["body"][k] for k in ("model", "temperature", "max_tokens")} == {
        "model": "gpt-4o", "temperature": 0.4, "max_tokens": 3000,
    }
    system, user = first["body"]["messages"]
    assert system == {"role": "system", "content": V.SYSTEM_MESSAGE}
    text = user["content"]
    assert "News ID: 7\n        Title: A title\n        Article: Text \"quoted\"\n" in text
    assert V.ANALYSIS_REQUIREMENTS in text and '"news_id": "7",' in text
    assert text.endswith('"historical_analogy": "<str | null>"\n        }\n        ')
    template = json.loads(text[text.index("        {\n") :])
    assert list(template)[0] == "news_id" and len(template) == 19
    total = analysis.batch_tokens(requests).first()
    assert total["n_requests"] == 2 and total["total_tokens"] > 600


def test_analysis_stage(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "tables"))
    cleaned = spark.createDataFrame([("1", "text one"), ("2", "text two"), ("3", None)], "news_id string, llm_ready_text string")
    dates = {"date_utc": F.lit("2024-01-05").cast("timestamp"), "year_utc": F.lit(2024), "month_utc": F.lit(1), "day_utc": F.lit(5)}
    warehouse.write_table("cleaned_data", cleaned.withColumns(dates))
    warehouse.write_table("raw_data", cleaned.select("news_id", F.lit("T").alias("title_text")).withColumns(dates))
    flags = {n: F.lit(n != "llm_data") for n in ("raw_data", "scraped_data", "cleaned_data", "llm_data")}
    warehouse.write_table("article_status_data", cleaned.select("news_id").withColumns(flags))
    assert {r["custom_id"] for r in pending_requests(warehouse).collect()} == {"article_1", "article_2"}
    answers = tmp_path / "answers"
    answers.mkdir()
    lines = [json.dumps([variant("1"), variant("2", positive=2)]), json.dumps([variant("unknown")])]
    (answers / "a.txt").write_text("\n".join(lines))
    rejected = store_responses(warehouse, read_responses(spark, str(answers)))
    assert [(r["news_id"], r["reason"]) for r in rejected.collect()] == [
        ("2", "invalid positive"),
        ("unknown", "no article with this id"),
    ]
    stored = warehouse.read_table("llm_data").collect()
    assert [(r["news_id"], r["day_utc"], r["risk_factors"]) for r in stored] == [("1", 5, [])]
    assert {r["custom_id"] for r in pending_requests(warehouse).collect()} == {"article_2"}
