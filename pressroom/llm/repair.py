"""Repair of a conversation's structure by generalised LR parsing with weighted edits.

The roles of a conversation are read by the tables of an LR automaton for ``(s?(ua)+)?``. Each row
may be kept, given the other role or deleted, and rows may be inserted anywhere. All stacks that
edits lead to are followed at once; they share their lower parts, and stacks that become equal are
merged, the one with the least (cost, audit) staying. The grammar's list is left-recursive, so
there is a fixed number of stacks however long a conversation is, and rows are read as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressroom.llm.common import map_batches, save

#: The role grammar: an optional system turn, then pairs of user and assistant turns, or nothing.
GRAMMAR = (("S", ()), ("S", ("T",)), ("S", ("s", "T")), ("T", ("u", "a")), ("T", ("T", "u", "a")))
ROLES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3
SPACE = " \t\n\x0b\x0c\r"
FINAL = (".", "!", "?")
LEGAL = ("su", "ua", "au")
_NONE = hashlib.sha256(b"").hexdigest()


class Tables:
    """LR tables of a grammar whose item sets have no conflict but reduce against end of input."""

    def __init__(self, grammar=GRAMMAR):
        self.grammar = grammar
        self.names = names = {left for left, _ in grammar}
        start = grammar[0][0]

        def closure(items):
            items = set(items)
            while True:
                wanted = {grammar[r][1][dot] for r, dot in items if dot < len(grammar[r][1])} & names
                more = {(r, 0) for r, (left, _) in enumerate(grammar) if left in wanted} - items
                if not more:
                    return frozenset(items)
                items |= more

        sets = [closure({(r, 0) for r, (left, _) in enumerate(grammar) if left == start})]
        self.go: dict[tuple[int, str], int] = {}
        for state in sets:  # grows while it is read
            for symbol in sorted({grammar[r][1][dot] for r, dot in state if dot < len(grammar[r][1])}):
                moved = closure({(r, dot + 1) for r, dot in state if grammar[r][1][dot : dot + 1] == (symbol,)})
                if moved not in sets:
                    sets.append(moved)
                self.go[sets.index(state), symbol] = sets.index(moved)
        #: Rules to reduce by as soon as a state is reached, and states that may end the input.
        self.reduce: dict[int, int] = {}
        self.ends: set[int] = set()
        for k, state in enumerate(sets):
            for r, dot in state:
                if dot == len(grammar[r][1]):
                    if grammar[r][0] == start:
                        self.ends.add(k)
                    else:
                        self.reduce[k] = r


class Stacks:
    """The graph of stacks: a node is a state above another node, and exists once."""

    def __init__(self) -> None:
        self.tables = Tables()
        self.nodes: list[tuple[int, int]] = [(0, -1)]
        self._number = {(0, -1): 0}
        self._shifted: dict[tuple[int, str], int | None] = {}

    def _push(self, state: int, below: int) -> int:
        key = state, below
        if key not in self._number:
            self._number[key] = len(self.nodes)
            self.nodes.append(key)
        return self._number[key]

    def shift(self, node: int, symbol: str) -> int | None:
        """The stack after one more role and all reductions; None if the grammar has no such prefix."""
        key = node, symbol
        if key not in self._shifted:
            state = None if symbol in self.tables.names else self.tables.go.get((self.nodes[node][0], symbol))
            top = None if state is None else self._push(state, node)
            while top is not None and self.nodes[top][0] in self.tables.reduce:
                left, right = self.tables.grammar[self.tables.reduce[self.nodes[top][0]]]
                for _ in right:
                    top = self.nodes[top][1]
                top = self._push(self.tables.go[self.nodes[top][0], left], top)
            self._shifted[key] = top
        return self._shifted[key]

    def ends(self, node: int) -> bool:
        return self.nodes[node][0] in self.tables.ends


class Audit:
    """A sequence of edits that shares its beginning with others."""

    __slots__ = ("before", "edit", "length")

    def __init__(self, before: Audit | None, edit: str):
        self.before, self.edit = before, edit
        self.length = before.length + 1 if before else 1


def edits(audit: Audit | None) -> str:
    out = []
    while audit is not None:
        out.append(audit.edit)
        audit = audit.before
    return "".join(reversed(out))


def less(a: Audit | None, b: Audit | None) -> bool:
    """Whether ``a`` is before ``b`` in ASCII order, from where the two part."""
    x, y = a, b
    while x is not None and y is not None and x.length > y.length:
        x = x.before
    while x is not None and y is not None and y.length > x.length:
        y = y.before
    if x is y or x is None or y is None:
        return (a.length if a else 0) < (b.length if b else 0)
    while x.before is not y.before:
        x, y = x.before, y.before
    if x.edit != y.edit:
        return x.edit < y.edit
    # The same edit after the same beginning, held twice: compare what follows.
    return edits(a) < edits(b)


class Parser:
    """Reads one conversation's rows in order and gives the cheapest edits."""

    stacks = Stacks()

    def __init__(self) -> None:
        self.tops: dict[int, tuple[int, Audit | None]] = {0: (0, None)}
        self._insert(self.tops)

    @staticmethod
    def _merge(tops: dict, node: int, cost: int, before: Audit | None, edit: str) -> bool:
        held = tops.get(node)
        if held is not None and held[0] < cost:
            return False
        audit = Audit(before, edit)
        if held is not None and held[0] == cost and not less(audit, held[1]):
            return False
        tops[node] = cost, audit
        return True

    def _insert(self, tops: dict) -> None:
        """All that inserted rows lead to; every insertion costs, so this ends."""
        new = list(tops)
        while new:
            node = new.pop()
            cost, audit = tops[node]
            for role in ROLES:
                to = self.stacks.shift(node, role)
                if to is not None and self._merge(tops, to, cost + INSERT, audit, "I"):
                    new.append(to)

    def read(self, initial: str, fault: str) -> None:
        tops: dict[int, tuple[int, Audit | None]] = {}
        gone = fault in ("blank", "duplicate")
        extra = UNFINISHED if fault == "truncated" else 0
        for node, (cost, audit) in self.tops.items():
            self._merge(tops, node, cost + DELETE, audit, "D")
            if gone:
                continue
            to = self.stacks.shift(node, initial)
            if to is not None:
                self._merge(tops, to, cost + extra, audit, "K")
            for role in ROLES:
                to = self.stacks.shift(node, role)
                if to is not None:
                    self._merge(tops, to, cost + REROLE + extra, audit, "R")
        self._insert(tops)
        self.tops = tops

    def end(self) -> tuple[int, str]:
        """Cost and audit of the cheapest repair; nothing and deletion are always one."""
        done = [(cost, edits(audit)) for node, (cost, audit) in self.tops.items() if self.stacks.ends(node)]
        return min(done)


class Edited:
    """What an audit makes of a conversation's rows, read one at a time."""

    def __init__(self, audit: str):
        self.audit, self.at, self.paired = audit, 0, 0

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            yield "I", self._next_role(), ""
            self.at += 1

    def _next_role(self) -> str:
        """The grammar leaves no choice: user and assistant in turn, after a system row that was kept."""
        self.paired += 1
        return ROLES["au"[self.paired % 2]]

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """``(edit, role, text)`` of rows inserted before this one and of this one, unless it goes."""
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.paired += role[:1] != "s"
            yield edit, role, text
        elif edit == "R":
            yield edit, self._next_role(), text

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


#: A conversation's rows in order, what is said of it as a whole before them.
ORDER = ["conv_id", "part", "turn", "role", "digest"]


def _turns(turns: DataFrame, id_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    digest = F.unhex(F.substring(F.sha2(text, 256), 1, 32))
    return turns.select(
        F.col(id_col).cast("long").alias("conv_id"), F.lit(1).alias("part"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), digest.alias("digest"), text.alias("text"),
    )


def fault(text: Column, earlier: Column) -> Column:
    """``blank``, ``duplicate`` (``earlier``: the same row came before) or ``truncated``, else empty."""
    trimmed = F.rtrim(text, F.lit(SPACE))
    return (
        F.when(trimmed == "", "blank").when(earlier, "duplicate")
        .when(~F.right(trimmed, F.lit(1)).isin(*FINAL), "truncated").otherwise("")
    )


def repairs(turns: DataFrame, ids: DataFrame | None = None, id_col: str = "conv_id") -> DataFrame:
    """The cheapest repair of each conversation's role structure.

    Returns ``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit)`` for the
    conversations of ``turns`` and those of ``ids`` alone, which have zeros and an empty audit. Rows
    go by ``turn`` (null first), role and a digest of the text; a null role or text is one space;
    rows of a null id are one conversation. Keeping a row costs nothing, another role 3, deletion 4
    (blank and repeated rows have no other way), an inserted row 3, a truncated row that stays 3
    more; of the cheapest edits the audit is the least in ASCII order. Texts are not shuffled. Other
    columns are ignored.
    """
    rows = _turns(turns, id_col)
    narrow = rows.withColumn("fault", fault(F.col("text"), F.lit(False))).drop("text")
    if ids is not None:
        none = F.lit(None)
        marks = ids.select(F.col(id_col).cast("long").alias("conv_id")).distinct().select(
            "conv_id", F.lit(0).alias("part"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
            none.cast("binary").alias("digest"), none.cast("string").alias("fault"),
        )
        narrow = narrow.unionByName(marks)
    # Rows and marks are dealt together: Spark takes a union of two sides dealt alike for dealt
    # already, though adaptive execution may merge the partitions of each side in its own way.
    same = Window.partitionBy("conv_id", "role", "digest").orderBy("turn")
    dealt = narrow.repartition("conv_id").withColumn("again", F.row_number().over(same) > 1)
    judged = dealt.withColumn("fault", F.when((F.col("fault") != "blank") & F.col("again"), "duplicate").otherwise(F.col("fault")))
    judged = judged.sortWithinPartitions(*ORDER).select(
        "conv_id", "part", "turn", F.substring("role", 1, 1).alias("initial"), "fault"
    )
    schema = pa.schema([
        *[(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, conv, found = False, None, None
        for batch in batches:
            done = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "turn", "initial", "fault"))):
                if not begun or row[0] != conv:
                    if begun:
                        done.append((conv, *found.end()))
                    begun, conv, found = True, row[0], Findings()
                if row[1]:
                    found.read(*row[2:])
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)] or [pa.array([], f.type) for f in schema], schema=schema)
        if begun:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((conv, *found.end()), schema)], schema=schema)

    kinds = ", ".join(f"{f.name} {'string' if f.type == pa.string() else 'long'}" for f in schema)
    return save(map_batches(judged, work, kinds), "repairs")


class Findings:
    """Figures of one conversation's rows, read in order."""

    def __init__(self) -> None:
        self.parser = Parser()
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.distinct = 0
        self.first = self.last = self.before = None

    def read(self, turn: int | None, initial: str, fault: str) -> None:
        self.parser.read(initial, fault)
        if fault:
            self.counts[fault] += 1
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.distinct += 1

    def end(self) -> tuple:
        gaps = self.last - self.first + 1 - self.distinct if self.distinct else 0
        return (gaps, *self.counts.values(), self.illegal, *self.parser.end())


def _edited(turns: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """Each conversation's audit as the first row, and its rows with their texts."""
    rows = _turns(turns, id_col)
    none = F.lit(None)
    audits = found.filter("audit <> ''").select(
        "conv_id", F.lit(0).alias("part"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("binary").alias("digest"), F.col("audit").alias("text"),
    )
    dealt = rows.unionByName(audits).repartition("conv_id").sortWithinPartitions(*ORDER)
    return dealt.select("conv_id", "part", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bool, tuple[str, str, str] | None]]:
    """``(conversation, whether it begins, edited row)`` of sorted rows; batch ends are marked by None."""
    conv = edited = None
    for batch in batches:
        for key, part, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "role", "text"))):
            if part == 0:
                if edited is not None:
                    yield from ((conv, False, row) for row in edited.end())
                conv, edited = key, Edited(text)
                yield conv, True, None
            else:
                yield from ((conv, False, row) for row in edited.row(role, text))
        yield conv, False, None
    if edited is not None:
        yield from ((conv, False, row) for row in edited.end())


def repaired_turns(turns: DataFrame, found: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``(conv_id, turn, edit, role, text)``: the repaired conversations, turns from 0.

    ``found`` is what ``repairs`` gave for the same ``turns``; conversations that lose all rows have none.
    """
    schema = pa.schema([(id_col, pa.int64()), ("turn", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        number = 0
        for conv, begins, row in _conversations(batches):
            if begins:
                number = 0
            elif row is not None:
                out.append((conv, number, *row))
                number += 1
            elif out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return map_batches(_edited(turns, found, id_col), work, f"`{id_col}` long, turn long, edit string, role string, text string")


def repaired_digests(turns: DataFrame, found: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """``found`` with ``repaired_sha256``: of the repaired rows as ``role:text``, joined by line feeds."""
    schema = pa.schema([("conv", pa.int64()), ("repaired_sha256", pa.string())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now, running, rows = None, None, 0
        for conv, begins, row in _conversations(batches):
            if begins:
                if running is not None:
                    out.append((now, running.hexdigest()))
                now, running, rows = conv, hashlib.sha256(), 0
            elif row is not None:
                running.update(f"{chr(10) if rows else ''}{row[1]}:{row[2]}".encode())
                rows += 1
            elif out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if running is not None:
            out.append((now, running.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    digests = map_batches(_edited(turns, found, id_col), work, "conv long, repaired_sha256 string")
    joined = found.join(digests, F.col("conv_id").eqNullSafe(F.col("conv")), "left").drop("conv")
    return joined.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(_NONE)))
