"""Prefix trie, shards and conversation repair against brute force."""

import hashlib
import random
import re
import zlib

import pytest

from pressroom.llm import repair, sharding, trie
from pressroom.llm.queries import damaged, llm_queries


def write(session, path, name, rows, spec):
    session.createDataFrame(rows, spec).write.parquet(f"{path}/{name}.parquet")
    return str(path)


# -- prefix trie -----------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth int, path string"


def rebuilt_lists(rows):
    by = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            by.setdefault(c, []).append((t is not None, t, role or "", text or ""))
    by = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    out = {}
    for c, own in by.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = by.get(c - c % 100, [])[:h] + own[h:]
    return out


def naive_trie(paths):
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = set()
    for node, convs in members.items():
        below = [k for k in members if k[: len(node)] == node]
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        out.add((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs),
            sum(len(k) == len(node) + 1 for k in below), sum(not any(len(m) == len(k) + 1 and m[:-1] == k for m in below) for k in below),
            sum((len(members[k]) - 1) * len(k[-1][1]) for k in below if k), hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return out


def some_conversations(rng, n):
    rows = []
    for c in [*range(n), 1000, 1003, 2007]:
        length = rng.choice([1, 1, 2, 3, 5, 9])
        for t in range(length):
            text = rng.choice(["a", "b", "é" * 3, None, "", "lang " * 40])
            rows.append((c, None if rng.random() < 0.1 else t, rng.choice(["user", "assistant", None]), text, 1, "x"))
    rows += [(c, t, "user", "same", 1, "x") for c in range(3000, 3040) for t in range(3)]
    rows += [(c, t, "user", "same", 1, "x") for c in range(100, 101) for t in range(3)]
    rows += [(None, 1, "user", "nobody's", 1, "x"), (5000, 0, "user", "alone", 1, "x")]
    rows += [(7, t, "user", str(t % 3), 1, "x") for t in range(20, 90)]
    return rows


def test_nodes_are_those_of_all_prefixes(session, tmp_path):
    rows = some_conversations(random.Random(3), 60)
    path = write(session, tmp_path, "conversations", rows, TURNS)
    got = llm_queries()["op11_prefix_trie"](session, path)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found))
    assert set(found) == naive_trie(rebuilt_lists(rows))


@pytest.mark.parametrize("bounds", [(20, 1 << 20), (1 << 16, 60)])
def test_blocks_change_no_node(session, bounds):
    rng = random.Random(sum(bounds))
    rows = [r for r in some_conversations(rng, 40) if r[1] is not None and r[0] is not None]
    turns = session.createDataFrame(rows, TURNS)
    plain = {}
    for c, t, role, text, *_ in sorted(rows, key=lambda r: r[:2]):
        plain.setdefault(c, []).append((t, role or "", text or ""))
    if any(len({t for t, _, _ in v}) < len(v) for v in plain.values()):
        plain = {c: sorted(v) for c, v in plain.items()}
    nodes = trie.prefix_trie(trie.conversation_turns(turns), *bounds)
    texts = trie.with_last_turns(nodes, turns)
    found = [tuple(r[c] for c in nodes.columns if c != "turn") for r in nodes.collect()]
    want = naive_trie({c: [x[1:] for x in v] for c, v in plain.items()})
    assert len(found) == len(want) and set(found) == want
    roots = texts.filter("depth = 0").collect()
    assert len(roots) == 1 and roots[0]["text"] is None
    firsts = {(r["role"], r["text"]) for r in texts.filter("depth = 1").collect()}
    assert firsts == {v[0][1:] for v in plain.values()}


def test_no_conversations_and_turnless_ones(session, tmp_path):
    path = write(session, tmp_path, "conversations", [], TURNS)
    assert llm_queries()["op11_prefix_trie"](session, path).collect() == []
    none = session.createDataFrame([(5, None), (3, [])], "conv_id long, turns array<binary>")
    assert [r["n_convs"] for r in trie.prefix_trie(none).collect()] == [2]


# -- shards ----------------------------------------------------------------------------------


def naive_best_fit(items, capacity):
    gaps, where = [], []
    for size in items:
        fits = [(gap, i) for i, gap in enumerate(gaps) if gap >= size]
        if fits:
            i = min(fits)[1]
        else:
            gaps.append(capacity)
            i = len(gaps) - 1
        gaps[i] -= size
        where.append(i)
    return where


@pytest.mark.parametrize("seed", range(6))
def test_runs_are_best_fit_decreasing(seed):
    rng = random.Random(seed)
    items = sorted((rng.choice([1, 2, 3, 7, 20, 21, 50, 64, 100]) for _ in range(300)), reverse=True)
    sizes = sorted(set(items), reverse=True)
    runs = sharding.best_fit_decreasing(sizes, [items.count(s) for s in sizes], 100)
    where = [shard for _, n, shard in runs for _ in range(n)]
    assert [s for i, n, _ in runs for s in [sizes[i]] * n] == items
    assert where == naive_best_fit(items, 100)
    assert sharding.best_fit_decreasing(sizes, [items.count(s) for s in sizes], 100, max(where)) is None


@pytest.mark.parametrize("seed", range(6))
def test_even_shards_are_near_equal(seed):
    rng = random.Random(seed)
    items = [rng.randrange(1, 4000) for _ in range(800)] + [1] * 300 + [10**6] * (seed % 3)
    sizes = sorted(set(items), reverse=True)
    loads = [0] * 16
    runs = sharding.even_shards(sizes, [items.count(s) for s in sizes], 16)
    for i, n, shard in runs:
        loads[shard] += n * sizes[i]
    assert sum(loads) == sum(items) and sum(n for _, n, _ in runs) == len(items)
    rest = sorted(loads)[: 16 - seed % 3]
    assert max(rest) - min(rest) <= 0.003 * max(rest)


def test_documents_in_shards(session, documents, tmp_path):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choices("abcé ", k=rng.randrange(1, 400))), "s") for i in range(700)]
    rows += [(i, "copy of one text", "s") for i in range(1000, 1300)] + [(None, "x", "s"), (5, None, "s"), (5, None, "s"), (6, "", None)]
    docs = documents(rows).repartition(5)
    got = sharding.assign_shards(docs, 16).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _ in rows
    )
    loads, slots, groups = [0] * 16, {}, {}
    for r in got:
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
        groups.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert all(len(v) == 1 for v in groups.values())
    assert max(loads) - min(loads) <= 0.01 * max(loads)
    name = sharding.write_shards(docs.withColumn("shard", docs.id), str(tmp_path / "out"), None, 20_000)
    written = session.read.parquet(str(tmp_path / "out"))
    assert name == "_shard" and set(written.columns) == {*docs.columns, "shard", "_shard"}
    assert written.count() == len(rows)
    totals = {}
    for r in written.collect():
        totals[r["_shard"]] = totals.get(r["_shard"], 0) + len((r["text"] or "").encode()) + 1
    assert max(totals.values()) <= 20_000
    assert sorted(totals) == list(range(-(-sum(loads) // 20_000)))
    assert sharding.assign_shards(docs.limit(0)).collect() == []
    few = sharding.assign_shards(documents([(1, "a", "s"), (2, "a", "s"), (3, "bbbb", "s")])).collect()
    assert len({r["shard"] for r in few}) == 2
    with pytest.raises(ValueError):
        sharding.assign_shards(docs, None)


def test_query_of_shards(session, documents, tmp_path):
    documents([(i, "t" * i, "s") for i in range(40)]).write.parquet(str(tmp_path / "documents.parquet"))
    got = llm_queries()["op12_sharding"](session, str(tmp_path))
    assert got.dtypes == [
        ("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"),
        ("slot", "bigint"), ("grown_shard", "int"),
    ]
    assert {(r["doc_id"], r["size"], r["law"], r["grown_shard"]) for r in got.collect()} == {(i, i + 1, "bytes", None) for i in range(40)}


# -- repair ----------------------------------------------------------------------------------


def naive_repair(rows):
    """Least (cost, audit) over all edits, by exhaustion: whole audits, grown row by row."""
    def fits(roles):
        return re.fullmatch(r"(s?(ua)*u?)?", roles) is not None

    level = {"": (0, "")}  # roles so far -> least (cost, audit)

    def inserted(level):
        for _ in range(3):
            for roles, (cost, audit) in list(level.items()):
                for r in "ua":
                    put(level, roles + r, (cost + 3, audit + "I"))
        return level

    def put(level, roles, value):
        if fits(roles) and (roles not in level or value < level[roles]):
            level[roles] = value

    inserted(level)
    for initial, fault in rows:
        now = {}
        for roles, (cost, audit) in level.items():
            put(now, roles, (cost + 4, audit + "D"))
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if len(initial) == 1 and initial in "sua":
                    put(now, roles + initial, (cost + extra, audit + "K"))
                for r in "ua":
                    put(now, roles + r, (cost + 3 + extra, audit + "R"))
        level = inserted(now)
    return min(v for k, v in level.items() if re.fullmatch(r"(s?(ua)+)?", k))


@pytest.mark.parametrize("seed", range(20))
def test_parser_finds_the_cheapest_edits(seed):
    rng = random.Random(seed)
    for _ in range(12):
        rows = [
            (rng.choice(["s", "u", "a", "u", "a", "t", "", "T", "S"]), rng.choice(["", "", "", "blank", "duplicate", "truncated"]))
            for _ in range(rng.randrange(7))
        ]
        parser = repair.Parser()
        for row in rows:
            parser.read(*row)
        assert parser.end() == naive_repair(rows), rows


def test_stacks_stay_few():
    parser = repair.Parser()
    for k in range(3000):
        parser.read("usaat"[k * 7 % 5], ["", "", "truncated", "blank"][k * 11 % 4])
    assert len(parser.stacks.nodes) < 20
    cost, audit = parser.end()
    assert cost > 0 and sum(e != "I" for e in audit) == 3000


def naive_damage(rows):
    out = {}
    for c, t, role, text, *_ in rows:
        out.setdefault(c, [])
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[c] += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for c, v in out.items():
        v.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()[:16]))
    return out


def naive_findings(rows):
    faults, seen = [], set()
    for _, role, text in rows:
        rest = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not rest else "duplicate" if (role, text) in seen else "" if rest[-1] in ".!?" else "truncated")
        seen.add((role, text))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit = naive_repair(list(zip(initials, faults)))
    left, out = list(rows), []
    for edit in audit:
        role, text = left.pop(0)[1:] if edit != "I" else ("", "")
        if edit in "RI":
            pairs = [r for r in out if not r.startswith("s")]
            role = "assistant" if len(pairs) % 2 else "user"
        if edit != "D":
            out.append(f"{role}:{text}")
    digest = hashlib.sha256("\n".join(out).encode()).hexdigest()
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, digest), out


def test_damaged_conversations_against_brute_force(session, tmp_path):
    rng = random.Random(8)
    rows = []
    for c in [None, *range(120), -5]:
        for t in range(rng.randrange(1, 8)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["system", "user", "assistant"][t and 1 + (t - 1) % 2]
            text = rng.choice(["Hello. ", "What?", "no end", "é!\n", "", "  \t", "x.y", None])
            rows.append((c, None if rng.random() < 0.1 else t * rng.choice([1, 1, 2]), None if rng.random() < 0.05 else role, text, t, "y"))
    path = write(session, tmp_path, "conversations", rows, "conv_id long, turn long, role string, text string, part int, fault string")
    got = llm_queries()["op13_repair"](session, path)
    assert got.dtypes == [(c, "bigint") for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
        ("audit", "string"), ("repaired_sha256", "string")
    ]
    found = {r[0]: tuple(r[1:]) for r in got.collect()}
    want = {c: naive_findings(v) for c, v in naive_damage(rows).items()}
    assert found == {c: v for c, (v, _) in want.items()}
    turns = damaged(session.read.parquet(f"{path}/conversations.parquet"))
    repaired = {}
    for r in repair.repaired_turns(turns, got).orderBy("conv_id", "turn").collect():
        assert r["turn"] == len(repaired.setdefault(r["conv_id"], []))
        repaired[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert repaired == {c: out for c, (_, out) in want.items() if out}


def test_conversations_over_many_partitions(session, tmp_path):
    rows = [(c, t, "user", f"Text {c} {t}.") for c in range(3000) for t in range(4)]
    path = write(session, tmp_path, "conversations", rows, "conv_id long, turn long, role string, text string")
    name = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    session.conf.set(name, "4k")  # the larger side keeps more partitions than the smaller
    try:
        got = llm_queries()["op13_repair"](session, path).collect()
    finally:
        session.conf.unset(name)
    want = {c: naive_findings(v)[0] for c, v in naive_damage(rows).items()}
    assert len(got) == 3000 and {r[0]: tuple(r[1:]) for r in got} == want


def test_repair_of_nothing(session, tmp_path):
    path = write(session, tmp_path, "conversations", [], "conv_id long, turn long, role string, text string")
    assert llm_queries()["op13_repair"](session, path).collect() == []
