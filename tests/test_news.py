import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from pressroom.functions.dates import parse_feed_date, percent_text
from pressroom.functions.html import with_dense_text
from pressroom.functions.markup import read_page
from pressroom.operators import ingest, scrape, status
from pressroom.operators.articles import natural_left_join, with_selected_text
from pressroom.operators.numbering import numbered
from pressroom.plans.news import import_landings, process_news
from pressroom.schemas import FEED_ITEM, FETCHED_PAGE, METADATA
from pressroom.sources.feed import feed_items, read_feed_pages
from pressroom.sources.tables import Warehouse
from pressroom.streaming.imports import start_import

ITEM = dict(
    type="Article", source_name="s", tickers=["BTC"], topics=None, rank_score="1.5",
    sentiment="Neutral", title="T", text="short preview",
)


def item(i, url=None, date="Fri, 05 Jan 2024 10:00:00 -0500", **more):
    return {"news_id": str(i), "news_url": url or f"https://h.example/{i}", "date": date, **ITEM, **more}


def land(path, *pages):
    path.mkdir()
    with open(path / "pages.json", "w") as out:
        for number, data in enumerate(pages, 1):
            out.write(json.dumps({"page": number, "total_pages": len(pages), "data": data}) + "\n")
    return str(path)


def test_feed_stops_at_the_first_empty_page(spark, tmp_path):
    path = land(tmp_path / "in", [item(1), item(2)], [item(3)], [], [item(4)])
    rows = feed_items(read_feed_pages(spark, path)).orderBy("ordinal").collect()
    assert [r["news_id"] for r in rows] == ["1", "2", "3"]
    assert [r["ordinal"] for r in rows] == [100, 101, 200]


def test_total_pages_bounds_the_feed(spark, tmp_path):
    pages = read_feed_pages(spark, land(tmp_path / "in", [item(1)], [item(2)]))
    assert feed_items(pages.withColumn("total_pages", F.lit(1))).count() == 1


def test_each_landing_has_its_own_stop_page(spark, tmp_path):
    land(tmp_path / "landed=2024-01-01", [item(1)], [item(2)], [item(3, "u")], [item(4)])
    land(tmp_path / "landed=2024-01-02", [item(5)], [], [item(6)])
    land(tmp_path / "landed=2024-01-03", [item(7), item(8)], [item(9)], [item(10, "u")])
    items = feed_items(read_feed_pages(spark, str(tmp_path))).orderBy("ordinal").collect()
    assert [r["news_id"] for r in items] == ["1", "2", "3", "4", "5", "7", "8", "9", "10"]
    assert [r["ordinal"] for r in items][:4] == [100, 200, 300, 400] and len({r["ordinal"] for r in items}) == 9
    kept = ingest.feed_to_metadata(feed_items(read_feed_pages(spark, str(tmp_path)))).collect()
    assert {r["news_id"] for r in kept} == {"1", "2", "3", "4", "5", "7", "8", "9"}
    assert feed_items(read_feed_pages(spark, str(tmp_path)).limit(0)).collect() == []


def test_landed_days(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        land(tmp_path / f"landed={day}", [item(day)])
    pages = read_feed_pages(spark, str(tmp_path), first_day="2024-01-02", last_day="2024-01-02")
    assert [r["news_id"] for r in feed_items(pages).collect()] == ["2024-01-02"]


def test_metadata_rows(spark, tmp_path):
    path = land(
        tmp_path / "in",
        [item(1, "u"), item(2, "v", date="bad"), item(3, None, news_url=None)],
        [item(4, "u"), item(5, "v"), item(6, None, news_url=None), item(7, date=None)],
    )
    rows = ingest.feed_to_metadata(feed_items(read_feed_pages(spark, path))).collect()
    # The first copy of a URL wins even when its date is bad; null URLs count as one.
    assert {r["news_id"] for r in rows} == {"1", "3"}
    first = next(r for r in rows if r["news_id"] == "1")
    assert first["date_utc"] == dt.datetime(2024, 1, 5, 15)
    assert (first["year_utc"], first["month_utc"], first["day_utc"]) == (2024, 1, 5)
    assert first["rank_score"] == 1.5


def test_bad_score_fails_unless_lenient(spark, tmp_path):
    items = feed_items(read_feed_pages(spark, land(tmp_path / "in", [item(1, rank_score="x")])))
    assert ingest.feed_to_metadata(items, lenient=True).first()["rank_score"] is None
    with pytest.raises(Exception):
        ingest.feed_to_metadata(items).collect()


def test_dates(spark):
    texts = ["Fri, 05 Jan 2024 10:00:00 -0500", "2024-01-05T15:00:00Z", "5 Jan 2024 15:00:00 GMT", "?", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(parse_feed_date(F.col("t"))).collect()]
    assert got == [dt.datetime(2024, 1, 5, 15)] * 3 + [None, None]


def test_bounds(spark):
    empty = spark.createDataFrame([], METADATA)
    row = ingest.fetch_bounds(empty, "2024-03-10 12:00:00", "2024-01-01").first()
    assert row["start_date"] == dt.datetime(2024, 1, 1)
    seen = spark.createDataFrame([(dt.datetime(2024, 3, 11, 12),)], "date_utc timestamp")
    row = ingest.fetch_bounds(seen, "2024-03-12 12:00:00").first()
    # 24 hours earlier is after the clocks went forward.
    assert row["start_date"] == dt.datetime(2024, 3, 10, 8)
    assert row["end_date"] == dt.datetime(2024, 3, 12, 8)


def test_new_rows_and_status(spark):
    fetched = spark.createDataFrame([("1",), ("2",), (None,)], "news_id string")
    stored = spark.createDataFrame([("1",)], "news_id string")
    with_null = stored.union(spark.createDataFrame([(None,)], "news_id string"))
    assert {r[0] for r in ingest.new_rows(fetched, stored).collect()} == {"2", None}
    assert {r[0] for r in ingest.new_rows(fetched, with_null).collect()} == {"2"}
    rows = ingest.new_status(fetched.where("news_id is not null"), stored).collect()
    assert [tuple(r) for r in rows] == [("2", True, False, False, False)]


def test_pending_and_advance(spark):
    rows = [("1", True, False, False, False), ("2", True, True, False, False), ("3", True, True, True, False)]
    table = spark.createDataFrame(
        rows, "news_id string, raw_data boolean, scraped_data boolean, cleaned_data boolean, llm_data boolean"
    )
    assert [r[0] for r in status.pending_scrape(table).collect()] == ["1"]
    assert [r[0] for r in status.pending_clean(table).collect()] == ["2"]
    assert [r[0] for r in status.pending_analysis(table).collect()] == ["3"]
    done = spark.createDataFrame([("1",), ("1",), (None,)], "news_id string")
    after = {r["news_id"]: r["scraped_data"] for r in status.advance(table, done, "scraped_data").collect()}
    assert after == {"1": True, "2": True, "3": True}


PAGE = "<html><body><nav>Home</nav><p>Body text here.</p></body></html>"


def test_outcomes(spark):
    fetched = [
        ("ok", PAGE, 200, None, None, 0.5),
        ("bare", "<html><body></body></html>", 200, None, None, 0.5),
        ("empty", "", 200, None, None, 0.5),
        ("gone", None, 404, "http", "404 Not Found", 0.5),
        ("slow", None, None, "request", "timed out", 15.0),
        ("odd", None, None, "other", "boom", 0.5),
        ("lost", None, None, "outside", "pool", 0.5),
    ]
    out = scrape.fetch_outcomes(spark.createDataFrame(fetched, FETCHED_PAGE))
    got = {r["news_url"]: (r["full_text"], r["status_code"], r["error"], r["success"], r["elapsed_time"]) for r in out.collect()}
    assert got == {
        "ok": ("Body text here.", 200, None, True, 0.5),
        "bare": (None, 200, None, False, 0.5),
        "empty": (None, 200, "empty response", False, 0.5),
        "gone": (None, 404, "404 Not Found", False, 0.5),
        "slow": (None, 503, "timed out", False, 15.0),
        "odd": (None, 500, "boom", False, 0.5),
        "lost": (None, None, "Error: pool", False, 0.0),
    }
    assert tuple(scrape.fetch_summary(out).first()) == (7, 1, "14.3%")


def test_percent_text(spark):
    pairs = [(i, n) for n in (7, 40, 160, 400, 800, 2000) for i in range(n + 1)]
    rows = spark.createDataFrame(pairs, "id long, n long").select("id", "n", percent_text(F.col("id"), F.col("n")).alias("text"))
    for row in rows.collect():
        assert row["text"] == f"{row['id'] / row['n'] * 100:.1f}%"


def test_extraction(spark):
    html = """<!DOCTYPE html><html><head><title>No</title><script>var a="</p>";</script></head><body>
      <nav><a href="/">Home</a></nav><div class="side ad">Buy</div><!-- <p>hidden</p> -->
      <article><h1>Title &amp; more</h1><p><b>Bold</b> text<br>line &copy; &#8217;x&#x2019; &amp;lt; &#9999999;end &nope; R&D</p>
      <p><a href="x">only a link here</a> to</p><table><tr><td>1</td></tr></table></article>
      <footer>&copy; host</footer></body></html>"""
    fallback = "<html><body><p><a href='x'>A linked</a></p><p><a>Another link</a></p></body></html>"
    df = spark.createDataFrame([(1, "http://h/1", html), (2, "http://h/2", fallback), (3, "x", None)], "id int, url string, html string")
    got = {r["id"]: r["full_text"] for r in scrape.extract_text(df, "id").collect()}
    assert got == {
        1: "Title & more\nBold text\nline © ’x’ &lt; \ufffdend &nope; R&D",
        2: "A linked\nAnother link",
        3: None,
    }


def test_nested_and_unclosed_markup(spark):
    article = "<article><p>Kept text here.</p>%s<p>More kept text.</p></article>"
    inserted = [
        '<div class="ad"><div>Buy</div><p>Leaked promo text.</p></div>', "<DIV CLASS='ad'>Buy<ul><li>now</li></ul></DIV>",
        "<table><tr><td><table><tr><td>In</td></tr></table>Out</td></tr></table>", "<div id=sidebar>Buy</div>",
        "<script>if (a < b) '</p>' + \"<div>\"</script>", "<!-- <p>a > b</p> -->", "<form><form>x</form> y</form>",
        '<section class="x share-bar"><section>One</section> two words</section>',
    ]
    rows = [(i, article % x) for i, x in enumerate(inserted)]
    rows += [(20, article % "" + "<!-- " * 20_000), (21, article % "" + "<div " * 20_000), (22, "<script>" * 20_000 + article % "")]
    entities = [
        ("&eacute;&uuml;&szlig;&Zcaron; x", "éüßŽ x"), ("&#38;lt;b", "&lt;b"), ("&amp;eacute; &amp;lt;", "&eacute; &lt;"),
        ("&#x41;&#66; &nosuch; &copy 1", "AB &nosuch; &copy 1"), ("&#0;x&#xD800;", "\ufffdx\ufffd"), ("a &lt;b&gt; c", "a <b> c"),
    ]
    rows += [(30 + i, f"<p>{x}</p>") for i, (x, _) in enumerate(entities)] + [(40, None), (41, ""), (42, "a < b and <b>c</b>")]
    df = spark.createDataFrame(rows, "id int, html string")
    got = {r["id"]: r["full_text"] for r in scrape.extract_text(df, "id").collect()}
    whole = "Kept text here.\nMore kept text."
    assert {i: t for i, t in got.items() if i < 30} == {i: whole for i, *_ in rows if i < 30}
    assert [got[30 + i] for i in range(len(entities))] == [text for _, text in entities]
    assert [got[i] for i in (40, 41, 42)] == [None, None, "a < b and c"]
    started = time.perf_counter()
    read_page("<!-- " * 20_000)
    read_page("<div class='" * 20_000)
    assert time.perf_counter() - started < 1


def test_densest_run(spark):
    link = '<li><a href="/x">Some link text</a></li>'
    story = "".join(f"<p>{'word ' * n}end.</p>" for n in (30, 4, 40))
    rows = [
        (1, f"<body><ul>{link * 9}</ul><div>{story}</div><ul>{link * 9}</ul><p>Terms.</p></body>"),
        (2, "<p>Short one.</p>"), (3, None), (4, ""), (5, f"<article>{story}</article>"), (6, f"<ul>{link * 3}</ul>"),
    ]
    df = with_dense_text(spark.createDataFrame(rows, "id int, html string"))
    assert df.columns == ["id", "html", "full_text"]
    got = {r["id"]: r["full_text"] for r in df.collect()}
    text = "\n".join("word " * n + "end." for n in (30, 4, 40))
    assert got == {1: text, 2: "Short one.", 3: None, 4: None, 5: text, 6: None}


def landed_page(path, page, ids, total=9, lines=()):
    path.parent.mkdir(parents=True, exist_ok=True)
    item = lambda i: {"news_id": f"{i}", "news_url": f"https://h/{i}", "title": "t", "date": "2024-01-02T03:04:05Z"}
    pages = [(page, ids), *lines]
    path.write_text("\n".join(json.dumps({"page": p, "total_pages": total, "data": [item(i) for i in x]}) for p, x in pages))


def test_landings_of_every_layout(spark, tmp_path):
    flat, plain, keyed = (tmp_path / x for x in ("flat", "plain", "keyed"))
    landed_page(flat / "one.json", 1, [1, 2], lines=[(2, [])])
    landed_page(flat / "two.json", 1, [3], lines=[(2, [4]), (3, [5, 6])])
    landed_page(plain / "a" / "x.json", 1, [1])
    landed_page(plain / "b" / "deep" / "x.json", 1, [2])
    landed_page(keyed / "landed=2024-01-01" / "p1.json", 1, [1])
    landed_page(keyed / "landed=2024-01-01" / "p2.json", 2, [])
    landed_page(keyed / "landed=2024-01-01" / "p3.json", 3, [9])
    landed_page(keyed / "landed=2024-01-02" / "p3.json", 3, [3])
    landed_page(tmp_path / "written" / "part-0.json", 1, [])
    landed_page(tmp_path / "written" / "part-1.json", 2, [7])
    ids = lambda path, **days: sorted(r["news_id"] for r in feed_items(read_feed_pages(spark, str(path), **days)).collect())
    assert ids(flat) == ["1", "2", "3", "4", "5", "6"]
    assert ids(plain) == ["1", "2"]
    assert ids(keyed) == ["1", "3"]
    assert ids(keyed, first_day="2024-01-02") == ["3"]
    assert ids(tmp_path / "written") == []


def test_imported_landings_are_not_read_again(spark, tmp_path):
    warehouse, path = Warehouse(spark, str(tmp_path / "warehouse")), tmp_path / "feed"
    landed_page(path / "one.json", 1, [1, 2])
    run = lambda now: import_landings(warehouse, str(path), now)
    first = run("2024-01-03 00:00:00")
    assert (first["n_rows"], first["n_landings"]) == (2, 1)
    (path / "one.json").write_text("not JSON any more")  # would fail or add rows if it were read
    landed_page(path / "two.json", 1, [2, 3])
    landed_page(path / "landed=2023-12-20" / "old.json", 1, [4])
    second = run("2024-01-04 00:00:00")
    assert (second["n_rows"], second["n_landings"]) == (1, 1)
    assert run("2024-01-05 00:00:00") == {"n_rows": 0, "n_landings": 0}
    assert sorted(r["news_id"] for r in warehouse.read_table("raw_data").collect()) == ["1", "2", "3"]
    assert warehouse.read_table("article_status_data").count() == 3
    assert warehouse.read_table("feed_landings").count() == 2


def test_repeated_blocks(spark):
    rows = [(i, f"http://h.example/{i}", f"<p>Own text {i}.</p><p>Subscribe to us.</p><p>Subscribe to us.</p>") for i in range(4)]
    rows.append((9, "http://other.example/", "<p>Subscribe to us.</p>"))
    df = spark.createDataFrame(rows, "id int, url string, html string")
    got = {r["id"]: r["full_text"] for r in scrape.extract_text(df, "id", min_pages=2).collect()}
    assert got == {**{i: f"Own text {i}." for i in range(4)}, 9: "Subscribe to us."}


def test_progress_over_sparse_ordinals(spark):
    rows = [(i * 10**12, i % 4 != 0) for i in range(250)]
    df = spark.createDataFrame(rows, "ordinal long, success boolean")
    got = {(r["ordinal"], r["n"]) for r in numbered(df, ["ordinal"], "n").collect()}
    assert got == {(i * 10**12, i) for i in range(250)}
    chunks = [tuple(r) for r in scrape.fetch_progress(df, "ordinal").orderBy("chunk").collect()]
    assert chunks == [(0, 100, 75, 100, 75, "75.0%"), (1, 100, 75, 200, 150, "75.0%"), (2, 50, 37, 250, 187, "74.8%")]


def test_numbers_inside_keys(spark):
    rows = [(None if i % 5 == 0 else "a" if i % 3 else f"k{i % 7}", -i, "x") for i in range(400)] + [("a", -8, "x")] * 3
    df = spark.createDataFrame(rows, "k string, v int, _size string").repartition(7)
    got = numbered(df, ["v"], "n", by=["k"])
    assert got.columns == ["k", "v", "_size", "n"]
    want = {}
    for k, v, _ in sorted(rows, key=lambda r: r[1]):
        want.setdefault(k, []).append(v)
    found = {}
    for r in sorted(got.collect(), key=lambda r: r["n"]):
        assert r["n"] == len(found.setdefault(r["k"], []))
        found[r["k"]].append(r["v"])
    assert found == want
    assert numbered(df.limit(0), ["v"], "n").count() == 0


def test_natural_join(spark):
    left = spark.createDataFrame([(1, None, "a"), (2, "u", "b"), (3, "v", "c")], "id int, url string, x string")
    right = spark.createDataFrame([(1, None, 10), (2, "w", 20), (3, "v", 30)], "id int, url string, y int")
    got = {tuple(r) for r in natural_left_join(left, right).collect()}
    assert got == {(1, None, "a", 10), (2, "u", "b", None), (3, "v", "c", 30)}


def test_best_text(spark):
    cases = [(120, 110, "p"), (120, 120, "f"), (99, None, None), (None, None, None), (150, None, "p"), (50, 10, "f")]
    df = spark.createDataFrame(
        [(i, "p", None if f is None else "f", p, f) for i, (p, f, _) in enumerate(cases)],
        "i int, preview_text string, full_cleaned_text string, preview_text_word_count int, full_cleaned_text_word_count int",
    )
    got = {r["i"]: r["selected_text"] for r in with_selected_text(df).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def fetched_frame(spark):
    body = "<p>" + " ".join(f"Sentence number {i} about the coin market." for i in range(400)) + "</p>"
    rows = [
        ("https://h.example/1", body, 200, None, None, 0.1),
        ("https://h.example/2", None, None, "request", "timed out", 15.0),
    ]
    return spark.createDataFrame(rows, FETCHED_PAGE)


def test_flow_twice_changes_nothing(spark, tmp_path):
    path = land(tmp_path / "in", [item(1), item(2), item(3)])
    warehouse = Warehouse(spark, str(tmp_path / "tables"))

    def run():
        stages = process_news(
            warehouse, read_feed_pages(spark, path), fetched_frame(spark), "2024-01-06 00:00:00", "2024-01-01"
        )
        tables = {n: sorted(map(repr, warehouse.read_table(n).collect())) for n in warehouse.tables}
        return [(r["stage"], r["status"], r["n_rows"], r["error"]) for r in stages.collect()], tables

    first, tables = run()
    assert first == [("import", "success", 3, None), ("scrape", "success", 2, None), ("clean", "success", 2, None)]
    cleaned = {r["news_id"]: r for r in warehouse.read_table("cleaned_data").collect()}
    assert cleaned["1"]["selected_text_token_count"] > 1000 >= cleaned["1"]["llm_ready_text_token_count"] > 0
    assert cleaned["2"]["selected_text"] is None
    flags = {r["news_id"]: tuple(r)[1:] for r in warehouse.read_table("article_status_data").collect()}
    assert flags == {
        "1": (True, True, True, False),
        "2": (True, True, True, False),
        "3": (True, False, False, False),
    }
    second, again = run()
    assert [r[2] for r in second] == [0, 0, 0]
    assert again == tables


def test_failing_stage_ends_the_run(spark, tmp_path):
    path = land(tmp_path / "in", [item(1, rank_score="x")])
    stages = process_news(
        Warehouse(spark, str(tmp_path / "t")), read_feed_pages(spark, path), fetched_frame(spark), "2024-01-06 00:00:00", "2024-01-01"
    ).collect()
    assert [(r["stage"], r["status"]) for r in stages] == [("import", "error")] and stages[0]["error"]


def test_stream_import(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "tables"))
    source = tmp_path / "landed"
    for batch in ([item(1, "u"), item(2, "u"), item(3)], [item(3), item(4), item(5, date="bad")]):
        spark.createDataFrame([tuple(i[n] for n in FEED_ITEM.names) for i in batch], FEED_ITEM).write.mode("append").parquet(str(source))
        items = spark.readStream.schema(FEED_ITEM).parquet(str(source))
        start_import(warehouse, items, str(tmp_path / "check")).awaitTermination()
    rows = warehouse.read_table("raw_data").collect()
    assert len(rows) == 3
    assert {r["news_url"] for r in rows} == {"u", "https://h.example/3", "https://h.example/4"}
    status = warehouse.read_table("article_status_data").collect()
    assert sorted(r["news_id"] for r in status) == sorted(r["news_id"] for r in rows)
    assert all(r["raw_data"] and not r["scraped_data"] for r in status)


def test_bounded_feed_read_leaves_later_reads_alone(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        folder = tmp_path / "feed" / f"landed={day}"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text('{"page": 1, "total_pages": 1, "data": []}')
    flat = tmp_path / "flat"
    flat.mkdir()
    (flat / "a.json").write_text('{"page": 1, "total_pages": 1, "data": []}')
    for _ in range(2):
        assert read_feed_pages(spark, str(tmp_path / "feed"), first_day="2024-01-02").count() == 1
    assert read_feed_pages(spark, str(flat)).count() == 1
