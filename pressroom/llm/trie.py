"""Prefix trie of conversations by truncation peeling.

A conversation is a path: one element of 20 bytes for each turn, a 128-bit digest of role and text
and the number of code points of the text. Sorted paths are cut into blocks of bounded size. Each
block is peeled from its greatest depth: conversations that end at a depth join the nodes that
survived from below, nodes with the same turns become one, are counted and give up their last
turn. Nodes on a block's first or last path may go on in the neighbouring block; they stay open,
and their parts, one path with numbers for each depth, are the input of the next round, until one
block holds all. No group has to fit one task: a first turn or a whole conversation that a third
of the rows share is a run of blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pressroom.llm.common import map_batches, save

#: Bytes of one turn in a path: digest and code points.
TURN = 20
#: A block ends after so many rows, or with the row that takes its paths beyond so many bytes, but
#: not before it has ``LEAST_ROWS``: each round leaves at most two paths of a block.
BLOCK_ROWS = 1 << 16
BLOCK_BYTES = 8 << 20
LEAST_ROWS = 8
_FAR = np.iinfo(np.int64).max
#: Numbers of a node, added up over its parts; of ``least``, the smallest member, the least counts.
_PARTS = ("n_convs", "least", "n_children", "n_leaves", "saved")
_SCHEMA = pa.schema([
    ("kind", pa.string()), ("block", pa.int64()), ("node", pa.binary()),
    # closed nodes
    ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("parent", pa.binary()),
    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved", pa.int64()),
    ("ends", pa.binary()), ("turn", pa.binary()),
    # open paths
    ("path", pa.binary()), ("low", pa.int64()), ("opened", pa.list_(pa.binary())),
    *[(f"open_{name}", pa.list_(pa.int64())) for name in _PARTS],
    # ids of conversations that end at an open node
    ("first", pa.int64()), ("ids", pa.string()),
])
_ROW = ", ".join(
    f"{f.name} " + {"int64": "long", "list<item: int64>": "array<long>", "list<item: binary>": "array<binary>"}.get(
        str(f.type).replace("element:", "item:"), str(f.type)
    ) for f in _SCHEMA
)
_NONE = hashlib.sha256(b"").digest()


def turn_element(role: Column, text: Column) -> Column:
    """A turn's 20 bytes: 16 of a digest of role and text, 4 of the text's length; null is empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    return F.unhex(F.concat(digest, F.lpad(F.hex(F.length(text)), 8, "0")))


def conversation_turns(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``(conv_id, turns)``: each conversation's turn elements in order of ``turn``, null first.

    Turns of one number go by role and digest. One conversation is one row, at 20 bytes a turn;
    texts are not shuffled. Rows with a null id belong to no conversation. Columns other than id,
    ``turn``, ``role`` and ``text`` are ignored.
    """
    element = F.struct(
        F.col("turn").isNotNull().alias("given"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        turn_element(F.col("role"), F.col("text")).alias("element"),
    )
    rows = turns.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), element.alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t"))["element"].alias("turns"))


def path_of(turns: Column) -> Column:
    """The path of an array of turn elements."""
    return F.aggregate(turns, F.lit(b""), lambda path, turn: F.concat(path, turn))


def prefix_keys(path: bytes) -> list[bytes]:
    """Keys of the nodes of depth 0, 1, ... on a path."""
    running = hashlib.sha256()
    keys = [running.digest()]
    for at in range(0, len(path), TURN):
        running.update(path[at : at + TURN])
        keys.append(running.copy().digest())
    return keys


def shared_turns(a: bytes, b: bytes) -> int:
    """How many leading turns two paths share."""
    if a[:TURN] != b[:TURN]:
        return 0
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // TURN


class Block:
    """Sorted paths with numbers of their nodes: row i for the depths ``low[i]`` up to its own, from
    ``starts[i]`` on in each array of ``parts``."""

    def __init__(self, paths: list[bytes], low: np.ndarray, starts: np.ndarray, parts: dict[str, np.ndarray]):
        self.paths, self.low, self.starts, self.parts = paths, low, starts, parts
        self.size = np.array([len(p) // TURN for p in paths], np.int64)
        self.shared = np.array([-1] + [shared_turns(a, b) for a, b in zip(paths, paths[1:])], np.int64)
        #: How many turns all paths share: there the last path's nodes are those of the first.
        self.common = shared_turns(paths[0], paths[-1])

    @staticmethod
    def of_conversations(paths: list[bytes], ids: np.ndarray) -> Block:
        """Each conversation counts at the node where it ends."""
        none = np.zeros(len(ids), np.int64)
        low = np.array([len(p) // TURN for p in paths], np.int64)
        parts = dict(zip(_PARTS, (none + 1, ids, none, none, none)))
        return Block(paths, low, np.arange(len(ids)), parts)

    def peel(self, last: bool) -> tuple[dict[str, np.ndarray], list[tuple[int, int, dict[str, np.ndarray]]]]:
        """Closed nodes, and the open ones of the first and last path unless this is the ``last`` block.

        A closed node has the first row below it, its depth, its numbers and its parent: ``up``, the
        parent's least member, or ``up_open``, 1 or 2 if the parent is open on the first or last
        path. An open path is its row, the least depth and numbers by depth.
        """
        size, shared, end = self.size, self.shared, len(self.paths) - 1
        longest = np.argsort(-size, kind="stable")
        active = np.searchsorted(-size[longest], np.arange(-int(size.max()), 1), side="right")[::-1]
        edges = [{name: np.zeros(int(size[r]) + 1, np.int64) for name in _PARTS} for r in (0, end)]
        closed: dict[str, list[np.ndarray]] = {name: [] for name in ("row", "depth", "up", "up_open", *_PARTS)}
        above = np.zeros(0, np.int64)
        gone = {name: above for name in _PARTS}
        for depth in range(int(size.max()), -1, -1):
            rows = np.sort(longest[: active[depth]])
            begins = shared[rows] < depth
            first = rows[begins]
            node = np.cumsum(begins) - 1
            child = np.searchsorted(first, above, side="right") - 1
            here = self.low[rows] <= depth
            at = self.starts[rows[here]] + depth - self.low[rows[here]]
            own = {}
            for name in _PARTS:
                own[name] = np.full(len(first), _FAR if name == "least" else 0, np.int64)
                gather = np.minimum if name == "least" else np.add
                gather.at(own[name], node[here], self.parts[name][at])
                if name != "n_children":
                    gather.at(own[name], child, gone[name])
            np.add.at(own["n_children"], child, 1)
            open_ = np.zeros(len(first), np.int64)
            if not last:
                if depth > self.common and depth <= size[end]:
                    open_[-1] = 2
                if depth <= size[0]:
                    open_[0] = 1
                for edge, which in zip(edges, (1, 2)):
                    for i in np.flatnonzero(open_ == which):
                        for name in _PARTS:
                            edge[name][depth] = own[name][i]
            if closed["up"]:
                closed["up"][-1], closed["up_open"][-1] = own["least"][child], open_[child]
            keep = open_ == 0
            above, gone = first[keep], {name: own[name][keep] for name in _PARTS}
            gone["n_leaves"] = np.maximum(gone["n_leaves"], gone["n_children"] == 0)
            if depth:
                letters = [int.from_bytes(self.paths[r][depth * TURN - 4 : depth * TURN], "big") for r in above]
                gone["saved"] = gone["saved"] + (gone["n_convs"] - 1) * np.array(letters, np.int64)
            none = np.zeros(len(above), np.int64)
            for name, column in {"row": above, "depth": none + depth, "up": none, "up_open": none, **gone}.items():
                closed[name].append(column)
        edge_rows = []
        if not last:
            edge_rows.append((0, 0, edges[0]))
            if self.common < size[end]:
                low = self.common + 1
                edge_rows.append((end, low, {name: v[low:] for name, v in edges[1].items()}))
        return {name: np.concatenate(v) for name, v in closed.items()}, edge_rows


def _columns(n: int, **given) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in _SCHEMA], schema=_SCHEMA
    )


def _emit(block: Block, number: int, ids: np.ndarray | None, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows of one peeled block; ``ids`` are the conversations of the first round's paths."""
    nodes, edges = block.peel(last)
    paths, end = block.paths, len(block.paths) - 1
    edge_keys = {row: prefix_keys(paths[row]) for row, _, _ in edges}
    runs: dict[int, str] = {}
    if ids is not None:
        starts = [i for i in range(len(paths)) if i == 0 or paths[i] != paths[i - 1]]
        runs = {i: ",".join(map(str, ids[i:j].tolist())) for i, j in zip(starts, [*starts[1:], len(paths)])}
    ends, turns, parents, keys = [], [], [], []
    of_row: tuple[int, list[bytes]] = (-1, [])
    for row, depth, up_open in zip(nodes["row"].tolist(), nodes["depth"].tolist(), nodes["up_open"].tolist()):
        path = paths[row]
        turns.append(path[(depth - 1) * TURN : depth * TURN - 4] if depth else None)
        parents.append(edge_keys[0 if up_open == 1 else end][depth - 1] if up_open else None)
        if ids is None:
            ends.append(None)
            keys.append((row, depth))
        else:
            here = depth * TURN == len(path)
            ends.append(hashlib.sha256(runs.pop(row).encode()).digest() if here else _NONE)
    if ids is None:  # nodes that were open have a key, to find their ends and children
        found: list = [None] * len(keys)
        for i in sorted(range(len(keys)), key=lambda i: keys[i]):
            row, depth = keys[i]
            if of_row[0] != row:
                of_row = row, prefix_keys(paths[row])
            found[i] = of_row[1][depth]
        keys = found
    known = (nodes["up_open"] == 0) & (nodes["depth"] > 0)
    n = len(turns)
    out = _columns(
        n, kind=["closed"] * n, block=np.full(n, number), node=keys or [None] * n, conv_id=nodes["least"], depth=nodes["depth"],
        parent_conv_id=pa.array(nodes["up"], mask=~known), parent=parents, n_convs=nodes["n_convs"],
        n_children=nodes["n_children"], n_leaves=nodes["n_leaves"], saved=nodes["saved"], ends=ends, turn=turns,
    )
    yield from (out.slice(k, 1 << 14) for k in range(0, n, 1 << 14))
    for row, low, numbers in edges:
        yield _columns(
            1, kind=["open"], block=[number], path=[paths[row]], low=[low], opened=[edge_keys[row][low:]],
            **{f"open_{name}": [v] for name, v in numbers.items()},
        )
    for row, text in runs.items():
        on_first = block.paths[0][: len(paths[row])] == paths[row]
        node = edge_keys[0 if on_first else end][len(paths[row]) // TURN]
        yield _columns(1, kind=["ends"], block=[number], node=[node], first=[int(ids[row])], ids=[text])


def _blocks(batches: Iterator[pa.RecordBatch], bounds: tuple[int, int] | None) -> Iterator[pa.Table]:
    """Rows in a row, cut at the bounds of rows and bytes; all of them in one without bounds."""
    held: list[pa.RecordBatch] = []
    rows = weight = 0
    for batch in batches:
        size = np.array([len(p) for p in batch.column("path").to_pylist()], np.int64)
        at = 0
        for i in range(batch.num_rows):
            rows, weight = rows + 1, weight + int(size[i])
            if bounds and (rows >= bounds[0] or (weight >= bounds[1] and rows >= LEAST_ROWS)):
                yield pa.Table.from_batches([*held, batch.slice(at, i + 1 - at)])
                held, at, rows, weight = [], i + 1, 0, 0
        if at < batch.num_rows:
            held.append(batch.slice(at))
    if held:
        yield pa.Table.from_batches(held)


def _round(rows: DataFrame, number: int, bounds: tuple[int, int] | None) -> DataFrame:
    """One round over sorted rows; without bounds the partition is the last block."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = (number << 48) + (TaskContext.get().partitionId() << 24)
        for k, part in enumerate(_blocks(batches, bounds)):
            paths = part["path"].to_pylist()
            if "conv_id" in part.column_names:
                ids = part["conv_id"].to_numpy()
                yield from _emit(Block.of_conversations(paths, ids), base + k, ids, False)
                continue
            low = part["low"].to_numpy()
            sizes = np.array([len(p) // TURN for p in paths], np.int64) + 1 - low
            parts = {name: part[f"open_{name}"].combine_chunks().flatten().to_numpy() for name in _PARTS}
            yield from _emit(Block(paths, low, np.cumsum(sizes) - sizes, parts), base + k, None, bounds is None)

    return save(map_batches(rows, work, _ROW), "trie-round")


def _end_hashes(chunks: DataFrame) -> DataFrame:
    """``(node, ends)``: the digest of each node's comma-joined chunks of ids, read as a stream."""
    schema = pa.schema([("node", pa.binary()), ("ends", pa.binary())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, running = None, None
        for batch in batches:
            done = []
            for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if key != node:
                    if node is not None:
                        done.append((node, running.digest()))
                    node, running = key, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pydict({"node": [d[0] for d in done], "ends": [d[1] for d in done]}, schema)
        if node is not None:
            yield pa.RecordBatch.from_pydict({"node": [node], "ends": [running.digest()]}, schema)

    dealt = chunks.select("node", "first", "ids").repartition("node").sortWithinPartitions("node", "first")
    return map_batches(dealt, work, "node binary, ends binary")


def prefix_trie(conversations: DataFrame, block_rows: int = BLOCK_ROWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Nodes of the trie of ``(conv_id, turns)``, as ``conversation_turns`` gives them.

    Returns ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, turn)``: smallest member, number of turns, parent's smallest member (root: null),
    members, children, childless nodes in the subtree, code points saved in the subtree by keeping
    each node's last text once, hash of the ids that end here, digest of the last turn (root: null).
    Ids are unique and not null; null or empty ``turns`` end at the root. No conversations give no
    nodes, extra columns are ignored. A path (20 bytes a turn) has to fit a row; bounds of rows and
    bytes only cut the work and change no result.
    """
    spark = conversations.sparkSession
    path = path_of(F.coalesce("turns", F.array().cast("array<binary>")))
    paths = save(conversations.select("conv_id", path.alias("path")), "trie-paths")
    block_rows = max(block_rows, LEAST_ROWS)
    bounds = block_rows, block_bytes
    dealt = paths.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    rounds = [_round(dealt, 0, bounds)]
    while True:
        open_ = rounds[-1].filter("kind = 'open'").select("path", "low", *[f"open_{name}" for name in _PARTS])
        total = open_.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("path")).alias("b")).first()
        if not total["n"]:
            break
        if total["n"] <= block_rows and (total["b"] <= block_bytes or total["n"] <= LEAST_ROWS):
            rounds.append(_round(open_.repartition(1).sortWithinPartitions("path"), len(rounds), None))
            break
        parts = max(1, min(max(total["n"] // block_rows, total["b"] // block_bytes) + 1, total["n"] // (2 * LEAST_ROWS)))
        rounds.append(_round(open_.repartitionByRange(parts, "path").sortWithinPartitions("path"), len(rounds), bounds))
    rows = rounds[0]
    for more in rounds[1:]:
        rows = rows.unionByName(more)
    closed = rows.filter("kind = 'closed'")
    late = closed.filter("node is not null").select("node", F.col("conv_id").alias("up_id"))
    opened = rows.filter("kind = 'open'").select("block", F.explode("opened").alias("node"))
    up = opened.join(late, "node").select("block", F.col("node").alias("parent"), "up_id")
    resolved = closed.filter("parent is not null").join(up, ["block", "parent"]).withColumn("parent_conv_id", F.col("up_id"))
    nodes = closed.filter("parent is null").unionByName(resolved.select(closed.columns))
    hashes = _end_hashes(rows.filter("kind = 'ends'"))
    found = nodes.filter("node is not null").drop("ends").join(hashes, "node", "left").select(closed.columns)
    out = nodes.filter("node is null").unionByName(found)
    digest = F.lower(F.hex(F.coalesce("ends", F.lit(_NONE))))
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        digest.alias("ends_sha256"), "turn",
    )


def with_last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with ``role`` and ``text`` of their last turn, found among ``turns``; null at the root.

    Each different turn is looked up once, so a turn that many rows hold sends one row.
    """
    element = F.substring(turn_element(F.col("role"), F.col("text")), 1, TURN - 4)
    texts = turns.select(element.alias("turn"), *[F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")])
    return nodes.join(texts.dropDuplicates(["turn"]), "turn", "left").drop("turn")
