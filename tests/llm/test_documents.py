"""Classifiers, mixing, packing, archives, URL rules and languages on small tables."""

import gzip
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressroom.llm import language, links, mixing, packing, quality, toxicity, warc
from pressroom.llm.queries import RULES, llm_queries, tokenizer_path

BASE = "the of and to in is was for on that with as by at from this are be or an".split()


def prose(rng, n, extra=()):
    out = [rng.choice(BASE) if rng.random() < 0.5 else "".join(rng.choices("aeioulnrst", k=6)) for _ in range(n)]
    for word in extra:
        out.insert(rng.randrange(len(out) + 1), word)
    return " ".join(out)


# -- archives --------------------------------------------------------------------------------


def test_archives_round_trip(session, tmp_path):
    rng = random.Random(1)
    htmls = [None, "", "é" * 10, "a\r\n\r\nWARC/1.1\r\n", "x" * 50_000, "y" * 16_384] + [prose(rng, 40) for _ in range(9)]
    htmls += [htmls[4], htmls[4], htmls[6]]
    rows = [(i, f"https://h{i}.example/{i}\r\nx" if i % 4 else None, h, "clash") for i, h in enumerate(htmls)]
    pages = session.createDataFrame(rows, "page_id long, url string, html string, key string")
    path = str(tmp_path / "warc")
    warc.write_archives(warc.with_revisits(pages, "page_id", "url", "html"), path, segment=1000, chunk=300)
    records = warc.read_archives(session, path)
    assert records.filter("type = 'continuation'").count() > 50
    whole = warc.decoded(warc.reassemble(records)).collect()
    assert len(whole) == len(rows) and all(r["complete"] for r in whole)
    last = {}
    for i, _, html, _ in rows:
        last[(html or "").encode()] = i
    for r in whole:
        data = (htmls[int(r["key"])] or "").encode()
        response = last[data] == int(r["key"])
        assert r["type"] == ("response" if response else "revisit")
        assert r["digest"] == "sha1:" + warc.bare_digest(data)
        assert r["payload"] == (bytearray(data) if response else None)  # a revisit has no payload of its own


def test_smaller_payloads_are_all_responses(session):
    pages = session.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], "page_id long, url string, html string")
    rows = warc.with_revisits(pages, "page_id", "url", "html", least=3).collect()
    assert {r["key"] for r in rows if r["refers_to"]} == {3}
    assert warc.with_revisits(pages.limit(0), "page_id", "url", "html").collect() == []


def test_broken_segments_and_framing(session):
    spec = warc._RECORDS
    make = lambda id_, seg, origin, total, block: (id_, "response" if origin is None else "continuation", None, id_, None, None, seg, origin, total, block)
    rows = [
        make("a", 1, None, None, bytearray(b"12")), make("a2", 2, "a", 4, bytearray(b"34")), make("a2", 2, "a", 4, bytearray(b"34")),
        make("b", 1, None, None, bytearray(b"12")), make("b3", 3, "b", 4, bytearray(b"34")),
        make("c", 1, None, None, bytearray(b"12")), make("c2", 2, "c", 9, bytearray(b"34")),
        make("d2", 2, "d", 4, bytearray(b"34")),
    ]
    found = {r["record_id"]: r for r in warc.reassemble(session.createDataFrame(rows, spec)).collect()}
    assert bytes(found["a"]["block"]) == b"1234" and found["a"]["complete"]
    assert [(k, found[k]["complete"], found[k]["block"]) for k in "bcd"] == [(k, False, None) for k in "bcd"]
    assert warc.dechunked(b"3;x=1\r\nabc\r\n0\r\nT: 1\r\n\r\n") == b"abc"
    assert [warc.dechunked(x) for x in (b"", b"zz\r\n", b"5\r\nabc\r\n0\r\n", b"-1\r\n")] == [None] * 4
    assert warc.http_payload(b"no head") is None
    assert list(warc.parse_archive(b"junk")) == []


def test_damaged_archives_end_where_they_are_damaged(session, tmp_path):
    def record(key, block, length=None, more=""):
        head = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: {key}\r\n{more}Content-Length: {len(block) if length is None else length}\r\n\r\n"
        return head.encode() + block + b"\r\n\r\n"

    good = record("a", b"x" * 3_000_000) + record("b", b"")
    files = {
        "length": good + record("c", b"12", "x") + record("d", b"1"), "short": good + record("c", b"12", 50),
        "negative": good + record("c", b"12", -2), "none": b"", "junk": b"junk", "head": good + b"WARC/1.1\r\nWARC-Type: x",
        "tail": good + b"\x00\x01", "number": good + record("c", b"12", None, "WARC-Segment-Number: x\r\n"),
    }
    (tmp_path / "in").mkdir()
    for name, data in files.items():
        (tmp_path / "in" / f"{name}.warc").write_bytes(data)
        (tmp_path / "in" / f"{name}.warc.gz").write_bytes(gzip.compress(data[: len(good)]) + gzip.compress(data[len(good) :]))
    whole = gzip.compress(random.Random(1).randbytes(100_000))
    (tmp_path / "in" / "cut.warc.gz").write_bytes(gzip.compress(good) + whole[:50_000])
    (tmp_path / "in" / "bad.warc.gz").write_bytes(gzip.compress(good)[:-9] + b"123456789" + whole)
    found = Counter(r["record_id"] for r in warc.read_archives(session, str(tmp_path / "in")).select("record_id").collect())
    assert found["c"] == 2 and found["d"] == 0 and (found["a"], found["b"]) == (13, 13)


def test_query_of_archives_by_value(session, tmp_path):
    rng = random.Random(3)
    htmls = [None, "", "é" * 20_000, "a\r\n\r\nWARC/1.1", "z" * 70_000] + [prose(rng, 30) for _ in range(6)]
    rows = [(i * 3, None if i % 5 == 0 else f"https://h/{i}", rng.choice(htmls), "x") for i in range(60)]
    session.createDataFrame(rows, "page_id long, url string, html string, type string").repartition(3).write.parquet(str(tmp_path / "pages.parquet"))
    got = {r["page_id"]: tuple(r)[1:5] for r in llm_queries()["op1_warc"](session, str(tmp_path)).collect()}
    last = {}
    for i, _, html, _ in rows:
        last[html or ""] = i
    assert got == {
        i: (len((html or "").encode()), warc.bare_digest((html or "").encode()),
            "response" if last[html or ""] == i else "revisit", None if last[html or ""] == i else last[html or ""])
        for i, _, html, _ in rows
    }


# -- classifiers -----------------------------------------------------------------------------


def test_quality_is_learned_from_bytes(session):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        text = prose(rng, 60)
        rows.append((i, " ".join(w.upper() + "!!" for w in text.split()) if bad else text, "en", "s", 0))
        labels.append((i, int(not bad), 0))
    rows += [(1000, None, "en", "s", 0), (1001, "", "en", "s", 0), (1002, "fine words " * 40_000, None, None, None)]
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string, source string, _label int")
    labelled = session.createDataFrame(labels, "doc_id long, quality int, toxic int")
    network = quality.fit(docs, labelled.filter("doc_id % 5 != 0"))
    scored = docs.select("doc_id", quality.score(network)(F.col("text")).alias("s")).collect()
    score = {r["doc_id"]: r["s"] for r in scored}
    held = [(score[i] >= 0.5) == bool(q) for i, q, _ in labels if i % 5 == 0]
    assert np.mean(held) >= 0.95
    assert score[1000] == score[1001] and all(0 <= s <= 1 for s in score.values())
    long = rows[-1][1].encode()
    halves = network.scores([long, long[:7], b"\xff" * 40])
    assert abs(halves[0] - score[1002]) < 1e-9 and np.isfinite(halves).all()
    one = quality.fit(docs, labelled.filter("quality = 1"))
    assert one.scores([b"a"])[0] > 0.9
    assert quality.fit(docs, labelled.limit(0)).scores([b""])[0] == pytest.approx(0.5)


def test_network_sees_every_part_of_a_text():
    """The chunk features of a text in one piece equal those computed position by position."""
    rng = np.random.default_rng(0)
    net = quality.Network(
        rng.normal(size=(quality.WIDTH, 256, quality.FILTERS)).astype(np.float32), np.zeros(quality.FILTERS, np.float32),
        rng.normal(size=2 * quality.FILTERS).astype(np.float32), 0.1,
    )
    for n in (1, 31, 32, 256, 257, 480, 481, 1000):
        text = rng.integers(1, 256, n).astype(np.uint8).tobytes()
        blocks = max(1, -(-n // 32))
        data = np.frombuffer(text.ljust(blocks * 32, b"\0") + bytes(6), np.uint8)
        each = np.array([sum(net.table[k, data[t + k]] for k in range(7)) for t in range(blocks * 32)])
        starts = range(0, max(1, blocks - 1), 7)
        pooled = np.array([np.maximum(each[s * 32 : (s + 8) * 32].max(axis=0), 0) for s in starts])
        logit = np.concatenate([pooled.mean(axis=0), pooled.max(axis=0)]) @ net.weights + 0.1
        assert net.scores([b"other", text, b"\xff" * 40])[1] == pytest.approx(1 / (1 + np.exp(-np.clip(logit, -40, 40))), abs=1e-3)


def test_toxicity_grades(session):
    rng = random.Random(3)
    insults = ["idiot", "scum", "moron", "trash"]
    rows, labels = [], []
    for i in range(400):
        count = [0, 0, 0, 1, 3, 8][i % 6]
        rows.append((i, prose(rng, 80, rng.choices(insults, k=count)), "en", "s"))
        labels.append((i, int(count > 0)))
    rows += [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, prose(rng, 30_000), "en", "s")]
    docs = session.createDataFrame(rows, "doc_id long, text string, p_toxic string, grade string")
    labelled = session.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, labelled.filter("doc_id % 5 != 0"))
    graded = docs.select("doc_id", toxicity.grade(model)(F.col("text")).alias("g")).select("doc_id", "g.*").collect()
    by_id = {r["doc_id"]: r for r in graded}
    assert np.mean([(by_id[i]["p_toxic"] >= 0.5) == bool(t) for i, t in labels if i % 5 == 0]) >= 0.97
    severity = [np.mean([by_id[i]["severity"] for i in range(k, 400, 6)]) for k in (0, 3, 4, 5)]
    assert severity == sorted(severity) and severity[-1] > 2
    assert all(by_id[i]["grade"] == 0 for i in (1000, 1001, 1002))
    assert (np.diff(model.thresholds) > 0).all()
    nothing = toxicity.fit(docs, labelled.filter("toxic = 0"))
    assert nothing.exceed(["you idiot", None]).max() < 0.01


def test_language_from_all_evidence(session):
    rng = random.Random(4)
    letters = {"xx": "abcde", "yy": "vwxyz"}
    make = lambda lang, n: " ".join("".join(rng.choices(letters[lang], k=5)) for _ in range(n))
    rows = [(i, make("xx" if i % 2 else "yy", 40), "xx" if i % 2 else "yy", "s") for i in range(200)]
    odd = [(500, None), (501, ""), (502, "123 !!"), (503, "мир " * 50), (504, "e v"), (505, make("xx", 50_000)), (None, make("yy", 9))]
    rows += [(i, t, None, "s") for i, t in odd]
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string, host string")
    evidence = [(i, "xx" if i % 2 else "yy", "org", "a.org", f"h{i % 2}.a.org") for i in range(100)] + [(504, "yy", None, None, "h0.a.org")]
    known = session.createDataFrame(evidence, "doc_id long, declared string, suffix string, domain string, host string")
    found = {r["doc_id"]: r for r in language.identify(docs, known).collect()}
    assert len(found) == len(rows)
    assert all(found[i]["lang"] == lang and found[i]["kept"] for i, _, lang, _ in rows[:200])
    assert not any(found[i]["kept"] for i in (500, 501, 502, 503))
    assert found[504]["lang"] == "yy" and found[505]["lang"] == "xx" and found[None]["lang"] == "yy"
    assert language.identify(docs.limit(0)).collect() == []
    assert language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).filter("kept").count() == 0


def test_every_declared_language_is_fitted(session):
    rng = random.Random(10)
    letters = {f"l{k:02}": [chr(0x400 + 12 * k + j) for j in range(12)] for k in range(70)}
    make = lambda lang: " ".join("".join(rng.choices(letters[lang], k=6)) for _ in range(60))
    rows = [(100 * k + i, make(lang), lang) for k, lang in enumerate(letters) for i in range(3 if k < 66 else 2)]
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert all(found[i]["lang"] == lang and found[i]["kept"] for i, _, lang in rows)
    model = language.fit(docs.filter("lang < 'l02'"))
    other = language.identify(docs.filter("lang < 'l03'"), model=model).collect()
    assert all(r["kept"] and (r["lang"] is None) == (r["doc_id"] >= 200) for r in other)


# -- URL rules -------------------------------------------------------------------------------


def brute_rule(host, path):
    best = None
    for rule in RULES:
        head, _, tail = rule.text.partition("/")
        fits = host == head or host.endswith("." + head)
        if host and fits and (path or "/").startswith("/" + tail) and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return best


def test_rules_equal_brute_force(session):
    urls = [
        None, "", "nothing", "http://", "http://com", "HTTP://A.Example.COM/en/x?y#z", "https://www.example.com/en/",
        "https://example.com/en", "https://xexample.com/en/1", "ftp://a.net/es/1", "ftp://a.net/ES/1", "x://net?/es/",
        "http://a.net#/fr/", "http://a.org://b.net/fr/", "http://É.com/a", "a\nb://c.com/d\ne",
    ]
    pages = session.createDataFrame([(i, u, None, "h") for i, u in enumerate(urls)], "page_id long, url string, html string, host string")
    found = {r["page_id"]: r for r in links.judge(pages, RULES).collect()}
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
        rule = brute_rule(host, path)
        assert (found[i]["host"], found[i]["path"], found[i]["rule"]) == (host, path, rule and rule.text)
        if rule:
            assert found[i]["verdict"] == rule.action
    assert links.judge(pages.limit(0), RULES).collect() == []
    assert {r["verdict"] for r in links.judge(pages, []).collect()} == {"allow"}


def test_trust_and_distrust_spread_over_links(session):
    link = lambda *hosts: "".join(f"<a href='http://{h}/'>x</a>" for h in hosts)
    rows = [
        (1, "http://good.test/", link("fine.test")), (2, "http://fine.test/", ""), (3, "http://bad.test/", ""),
        (4, "http://farm.test/", link("bad.test")), (5, "http://other.test/", None), (6, None, link("bad.test")),
    ]
    pages = session.createDataFrame(rows, "page_id long, url string, html string")
    rules = [links.Rule.of("allow", "good.test/"), links.Rule.of("block", "bad.test/")]
    found = {r["page_id"]: r for r in links.judge(pages, rules).collect()}
    assert found[2]["trust"] > 0 and found[4]["distrust"] > links.THRESHOLD
    assert [found[i]["verdict"] for i in range(1, 7)] == ["allow", "allow", "block", "block", "allow", "allow"]


def test_walks_equal_power_iteration(session):
    rng = random.Random(12)
    hosts = [f"h{i}.test" for i in range(60)]
    edges = {(a, "h0.test"): rng.randrange(1, 4) for a in hosts[1:50]}  # a hub
    edges |= {(rng.choice(hosts), rng.choice(hosts)): rng.randrange(1, 9) for _ in range(150)}
    edges = {k: float(w) for k, w in edges.items() if k[0] != k[1]}
    seeds = [(h, float(i % 7 == 0), float(i % 5 == 1)) for i, h in enumerate(hosts)]
    found = links.spread(
        session.createDataFrame([(*k, w) for k, w in edges.items()], "src string, dst string, weight double"),
        session.createDataFrame(seeds, "host string, trust double, distrust double"),
    ).collect()
    n = np.zeros((60, 60))
    for (a, b), w in edges.items():
        n[hosts.index(a), hosts.index(b)] = w
    for column, matrix in ((1, n), (2, n.T)):
        share = matrix / np.maximum(matrix.sum(axis=1, keepdims=True), 1e-12)
        own = np.array([s[column] for s in seeds])
        value = own.copy()
        for _ in range(links.ROUNDS):
            value = own + links.DAMPING * (share.T @ value)
        assert np.allclose([next(r[column] for r in found if r["host"] == h) for h in hosts], value, atol=1e-9)


def test_links_of_every_form_and_rules_as_a_table(session):
    rows = [
        (1, "http://a.test/x", "<a href='//B.test/y'>1</a><img src=https://c.test:80/z><a href=/own>2</a><a href='mailto:x@d.test'>3</a>"),
        (2, "http://e.test/", "<base target=_top href='//f.test/dir/'><a href='x.html'>1</a><A HREF=\"/y\">2</A><a href='#top'>3</a><a href='//g.test'>4</a>"),
        (3, "http://h.test/", "<base href='/dir/'><a href='x.html'>1</a>"), (4, "http://h.test/", None),
    ]
    pages = session.createDataFrame(rows, "page_id long, url string, html string")
    edges = links.host_links(pages.withColumn("host", links.host_of(F.col("url"))), "html").collect()
    assert {(r["src"], r["dst"]): r["weight"] for r in edges} == {
        ("a.test", "b.test"): 1, ("a.test", "c.test:80"): 1, ("e.test", "f.test"): 2, ("e.test", "g.test"): 1,
    }
    table = [("block", "test", ""), ("allow", "a.test", "x"), ("allow", "", "x"), ("other", "h.test", ""), (None, "h.test", None)] * 2
    rules = session.createDataFrame(table, "action string, host string, path string")
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in links.judge(pages, rules).collect()}
    assert found == {1: ("a.test/x", "allow"), 2: ("test/", "block"), 3: ("test/", "block"), 4: ("test/", "block")}


# -- mixing and packing ----------------------------------------------------------------------


def test_mix_meets_targets(documents):
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randrange(1, 90)), f"s{i % 5}" if i % 11 else None) for i in range(400)]
    rows += [(900, None, "s0"), (901, "", "s0"), (902, "\x1c\u2003", "s1"), (None, "a b", "s1")] + [(950, "k " * 7, "s2")] * 4
    found = mixing.mix(documents(rows)).collect()
    again = mixing.mix(documents(rows[::-1])).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    size = lambda t: len((t or "").encode().split())
    assert Counter((r["doc_id"], r["size"]) for r in found) == Counter((i, size(t)) for i, t, _ in rows)
    totals = Counter()
    for _, t, s in rows:
        totals[s] += size(t)
    order = sorted(k for k in totals if k is not None) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, budget, open_ = {}, 1.5 * sum(totals.values()), set(order)
    while True:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = [s for s in open_ if level * weight[s] > 2 * totals[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2 * totals[s] for s in full}
        open_ -= set(full)
    source = {(i, size(t)): s for i, t, s in rows}
    taken = Counter()
    for r in found:
        s = source[(r["doc_id"], r["size"])]
        assert r["target"] == pytest.approx(target[s]) and r["source_size"] == totals[s]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in order)
    assert mixing.mix(documents([])).collect() == []


def test_fit_finds_the_best_sum():
    rng = np.random.default_rng(1)
    for _ in range(60):
        n = int(rng.integers(1, 7))
        lengths, counts = np.unique(rng.integers(1, 40, n), return_counts=True)
        counts = counts * int(rng.integers(1, 3))
        budget = int(rng.integers(0, (lengths * counts).sum() + 5))
        sums = {0}
        for length, count in zip(lengths.tolist(), counts.tolist()):
            sums = {s + k * length for s in sums for k in range(count + 1)}
        take = mixing.fit(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert (take * lengths).sum() == max(s for s in sums if s <= budget)
    lengths = np.array([61071, *range(66000, 76001, 2)])
    assert (mixing.fit(lengths, np.ones(len(lengths), int), 131071) * lengths).sum() == 131071
    lengths, counts = np.arange(1, 400), np.full(399, 1000)
    assert (mixing.fit(lengths, counts, 33_333_333, reach=5000) * lengths).sum() == 33_333_333


def test_pieces_hold_the_tokenizers_ids(documents):
    from tokenizers import Tokenizer

    rng = random.Random(6)
    odd = [
        None, "", "   ", "A\x1cb\x85c\xa0d", "áb don't X'LL ''s \"q\" 12½", "Σίσυφος ΣΑΣ İ é", "中文 Ａ🙂 \u200b", "x" * 5000,
        prose(rng, 9000), "a\r\nb\tc\x0bd",
    ]
    texts = odd + [prose(rng, 50) for _ in range(40)]
    rows = packing.token_pieces(documents([(i, t, None) for i, t in enumerate(texts)]), tokenizer_path(), 512).collect()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        got = ids.setdefault(r["doc_id"], [])
        assert (r["start"], r["length"]) == (len(got), len(r["ids"]) // 4) and r["piece"] == len(got) // 512
        got.extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert ids == {i: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}


def test_pieces_hold_the_ids_of_added_tokens(documents):
    from tokenizers import Tokenizer

    end, start = "<|endoftext|>", "<|startoftext|>"
    texts = [
        f"a{end}b", start, f"{start}{end}", f"x {end} {start}y\n{end}", f"don'{end}t I{start}'m", end.upper(), end[:-1],
        f"<|{end}", f"e{end}\u0301", f"ΣΑΣ{end}ΣΑΣ é{start}É", f"\u3000{end}\xa0{end}\x1c", "<|end oftext|>", f"a{end}" * 3000,
        "w " * 700_000 + f"w{end}w {start} " + "v " * 300_000,
    ]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    assert want[0] == [320, 49407, 321, 1] and want[1] == [49406, 1]
    rows = packing.token_pieces(documents([(i, t, None) for i, t in enumerate(texts)]), tokenizer_path(), 512).collect()
    ids = {i: [] for i in want}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        assert (r["start"], r["length"]) == (len(ids[r["doc_id"]]), len(r["ids"]) // 4)
        ids[r["doc_id"]].extend(np.frombuffer(r["ids"], "<u4").tolist())
    assert ids == want


def test_cache_turnover_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 20)
    rng = random.Random(7)
    encoder = packing.WordEncoder(tokenizer_path())
    texts = [prose(rng, 30).encode() for _ in range(40)]
    assert all(encoder.encode([t])[0].tobytes() == encoder.whole(t.decode()) for t in texts)


def test_parts_of_words_as_the_tokenizer_cuts_them():
    encoder = packing.WordEncoder(tokenizer_path())
    rng = random.Random(5)
    letters = "abcXYZ éÉßñÑİıŁłȺ×÷ΣσςЖ中0129'.,;!?-<|>\x02\x0b\x1c\xa0\u0301\u200d🙂ʼŉſ\n\t"
    texts = ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(3000)]
    texts += ["don't I'LL we've x''s ('s", "É É é é", "a\x02b \x02 c", "Ab9cd99.5%", "<|endoftext|>x <|END", "×÷ a×b"]
    got = encoder.encode([t.encode() for t in texts])
    assert [g.astype("<u4").tobytes() for g in got] == [encoder.whole(t) for t in texts]


def test_packing_replaces_clashing_columns(session):
    pieces = session.createDataFrame([(1, 0, 3, 9, 9, 7), (2, 0, 4, 9, 9, 7)], "doc_id long, piece int, length long, offset long, sequence_id long, _shard long")
    placed = packing.pack(pieces, ["doc_id", "piece"], capacity=10)
    assert set(placed.columns) == set(pieces.columns)
    assert sorted((r["offset"], r["_shard"]) for r in placed.collect()) == [(0, 7), (4, 7)]


def test_packing_is_gapless_and_tight(session, documents):
    rng = random.Random(8)
    rows = [(i, k, 0, rng.choice([100, 100, rng.randrange(1, 90), rng.randrange(1, 60)]), i) for i in range(900) for k in range(1 + i % 3 // 2)]
    rows += [(5000, 0, 0, 40, 1)] * 30 + [(None, 0, 0, 7, 1)]
    pieces = session.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")
    placed = packing.pack(pieces, ["doc_id", "piece"], capacity=100, shard=300).collect()
    assert len(placed) == len(rows)
    by_sequence = {}
    for r in placed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 100
    assert len(by_sequence) <= 1.03 * sum(r[3] for r in rows) / 100 + 1
    assert packing.pack(pieces.limit(0), ["doc_id"]).collect() == []


def test_sequences_join_the_ids(session, documents):
    pieces = packing.token_pieces(documents([(i, f"word{i} and more", None) for i in range(20)]), tokenizer_path(), 16)
    whole = packing.sequences(packing.pack(pieces, ["doc_id", "piece"], capacity=16)).collect()
    assert all(len(r["ids"]) == 4 * r["length"] for r in whole)
    assert sum(zlib.crc32(bytes(r["ids"])) > 0 for r in whole) == len(whole)
    assert hashlib.sha1(b"").hexdigest()


def test_rare_declared_languages_are_unknown_but_kept(session):
    words = "the quick brown fox jumps over the lazy dog again and again "
    rows = [(i, words * 3, "en") for i in range(1500)] + [(9000, "odd words of a dirty column " * 5, "dirty"), (9001, words, None)]
    docs = session.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.languages == ["en"]
    found = {r["doc_id"]: r for r in language.identify(docs, model=model).collect()}
    assert found[9000]["kept"] and found[9000]["lang"] is None and found[9001]["lang"] == "en"
