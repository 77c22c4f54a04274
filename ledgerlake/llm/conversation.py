"""Repair of conversations by a run-length edit program: the cheapest edits that leave a system turn at most, then user and assistant in turn.

Each turn is a symbol: it must go (blank, or role and text seen before in the conversation), or it has a role's initial and is
whole or truncated. What one symbol costs between the four states of the pattern is a min-plus matrix. Equal
symbols in a row are one run; a run of n advances by the matrices of the powers of two that make up n, which are cached. Costs to go
are carried backwards over runs; the edits are then unrolled forwards, halving a run until a turn is left, each
time the first edit in ASCII order that stays on a cheapest way. Unrolled halves are cached as well.

Plan: equal turns combine to one row with a count before they travel, so a turn that is repeated a million times is two runs.
Rows are sorted by a range of conversation and turn, which parts a conversation of any size among tasks, and cut into pieces of
bounded bytes, each with its matrix. A conversation that lies within one task's rows and one piece is settled there; the others'
pieces meet by conversation: first their matrices, last one first, for the costs
to go at each piece's end, then their texts, one piece at a time. A digest of a whole conversation is serial by nature; that
task holds a piece, a few numbers per piece and the letters of the audit.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache
from itertools import chain, repeat

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import tasks_for

#: States of the pattern ``(s?(ua)+)?``: nothing yet, after the system turn, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
INITIALS = "sua"
GONE = 0  # the symbol of turns that must go; others are 1 + role, and 4 more if truncated
FAR = 1 << 60
ROLES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
#: A piece closes at so many characters or turns.
PIECE_CHARS, PIECE_TURNS = 1 << 20, 1 << 14


@lru_cache(None)
def choices(symbol: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """Letters, cost and next state of what may be done with one turn, inserted turns before it included; in ASCII order."""
    out, before, at = [], "", state
    for n in range(3):  # a third insertion comes back to where one was
        cost = n * INSERT
        out.append((before + "D", cost + DELETE, at))
        if symbol != GONE:
            role, late = (symbol - 1) % 4, TRUNCATED * (symbol > 4)
            if (role == 0 and at == START) or (role in (1, 2) and FOLLOWS[at] == role + 1):
                out.append((before + "K", cost + late, role + 1))
            out.append((before + "R", cost + late + REROLE, FOLLOWS[at]))
        before, at = before + "I", FOLLOWS[at]
    return tuple(sorted(out))


def ended(state: int) -> tuple[str, int]:
    """Letters and cost of what completes the pattern after the last turn."""
    return {START: ("", 0), SYSTEM: ("II", 2 * INSERT), USER: ("I", INSERT), ASSISTANT: ("", 0)}[state]


END = tuple(ended(q)[1] for q in range(4))


def times(a: tuple, b: tuple) -> tuple:
    """Min-plus product of two matrices."""
    return tuple(tuple(min(x + b[k][j] for k, x in enumerate(row)) for j in range(4)) for row in a)


@lru_cache(None)
def power(symbol: int, k: int) -> tuple:
    """The matrix of 2**k turns of one symbol."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    return tuple(tuple(min((c for _, c, to in choices(symbol, q) if to == j), default=FAR) for j in range(4)) for q in range(4))


def before_run(symbol: int, n: int, togo: tuple) -> tuple:
    """Costs to go before a run of n, from those after it."""
    k = 0
    while n:
        if n & 1:
            togo = tuple(min(x + g for x, g in zip(row, togo, strict=True)) for row in power(symbol, k))
        n, k = n >> 1, k + 1
    return togo


@lru_cache(1 << 14)
def matrix(runs: tuple[tuple[int, int], ...]) -> tuple:
    """Min-plus product of a piece's runs, column by column."""
    columns = []
    for j in range(4):
        togo = tuple(0 if q == j else FAR for q in range(4))
        for symbol, n in reversed(runs):
            togo = before_run(symbol, n, togo)
        columns.append(tuple(min(x, FAR) for x in togo))
    return tuple(zip(*columns, strict=True))


@lru_cache(1 << 14)
def _half(symbol: int, k: int, state: int, togo: tuple) -> tuple[str, int]:
    """Letters and last state of 2**k turns; togo counted from its least."""
    if not k:
        letters, _, to = min(choices(symbol, state), key=lambda c: (c[1] + togo[c[2]], c[0]))
        return letters, to
    letters, state = _half(symbol, k - 1, state, _least(before_run(symbol, 1 << k - 1, togo)))
    more, state = _half(symbol, k - 1, state, togo)
    return letters + more, state


def _least(togo: tuple) -> tuple:
    low = min(togo)
    return tuple(g - low for g in togo)


def unroll(runs, state: int, togo: tuple) -> tuple[str, int]:
    """The edits of a piece's runs from a state, and the state after them, where togo are the costs to go at its end."""
    if not runs:
        return "", state
    after = [togo]
    for symbol, n in reversed(runs[1:]):
        after.append(before_run(symbol, n, after[-1]))
    out = []
    for (symbol, n), at_end in zip(runs, reversed(after), strict=True):
        while n:
            k = min(n.bit_length() - 1, 12)  # what is cached stays short
            n -= 1 << k
            letters, state = _half(symbol, k, state, _least(before_run(symbol, n, at_end)))
            out.append(letters)
    return "".join(out), state


BLANKS = " \t\n\x0b\x0c\r"


def _when() -> Column:
    """What orders turns of a conversation: their numbers, null first."""
    return F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))


def _symbols(rows: DataFrame, equal: DataFrame) -> DataFrame:
    """equal (distinct turns) plus ``fault`` (blank, duplicate, truncated or null) of the first of each.

    Where role and text come more than once is told by digests of rows, which combine before they travel: no text is sent for it.
    """
    digest = F.unhex(F.sha2("text", 256))
    seen = rows.where("n > 0").groupBy("id", "role", digest.alias("digest")).agg(F.min(_when()).alias("first"), F.count("*").alias("times")).where("times > 1")
    seen = seen.select(F.col("id").alias("_id"), F.col("role").alias("_role"), "digest", "first")
    j = equal.join(seen, F.col("id").eqNullSafe(F.col("_id")) & (F.col("role") == F.col("_role")) & (digest == F.col("digest")), "left")
    text, later = F.rtrim(F.col("text"), F.lit(BLANKS)), F.coalesce(_when() != F.col("first"), F.lit(False))
    fault = F.when(text == "", "blank").when(later, "duplicate").when(~F.right(text, F.lit(1)).isin(".", "!", "?"), "truncated")
    return j.select("id", "turn", "role", "text", "n", fault.alias("fault"))


_NAMES = "id phase place runs moves roles texts blank duplicate truncated illegal ends first last turns".split()
_PIECE = "phase int, place long, runs string, moves array<long>, roles array<string>, texts array<string>, blank long, duplicate long, truncated long, illegal long, ends string, first long, last long, turns long"


class _Piece:
    """Turns of one conversation in a row, as they come."""

    def __init__(self, own):
        self.own, self.runs, self.roles, self.texts = own, [], [], []
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.ends, self.first, self.last, self.turns, self.chars = 0, None, None, None, 0, 0

    def add(self, turn, role: str, text: str, n: int, fault: str | None) -> None:
        initial = role[:1]
        if self.ends:
            self.illegal += (self.ends[1], initial) not in LEGAL
        self.ends = (self.ends[0] if self.ends else initial, initial)
        self.illegal += n - 1
        if turn is not None and turn != self.last:
            self.first, self.last, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        must = fault in ("blank", "duplicate")
        kind = INITIALS.find(initial) if initial else -1
        self._run(GONE if must else 1 + (kind if kind >= 0 else 3) + 4 * (fault == "truncated"), 1)
        if fault:
            self.faults[fault] += 1
        if n > 1:
            self._run(GONE, n - 1)
            self.faults["blank" if fault == "blank" else "duplicate"] += n - 1
        if not must:
            self.roles.append(role), self.texts.append(text)
            self.chars += len(text)

    def _run(self, symbol: int, n: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            n += self.runs.pop()[1]
        self.runs.append((symbol, n))

    def rows(self, place: int) -> list[tuple]:
        moves = [x for row in matrix(tuple(self.runs)) for x in row]
        head = (self.own, 0, -place, None, moves, None, None, 0, 0, 0, 0, None, None, None, 0)
        runs = ",".join(f"{s}*{n}" for s, n in self.runs)
        return [head, (self.own, 1, place, runs, None, self.roles, self.texts, *self.faults.values(), self.illegal, "\n".join(self.ends) if self.ends else None, self.first, self.last, self.turns)]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _settled(piece: _Piece, lines: bool) -> str:
    """What a conversation of one piece comes to: its repaired turns, or its counts, audit and digest."""
    one = _Conversation(piece.own)
    head, body = piece.rows(0)
    one.step(head[4])
    turns = [*one.repaired(dict(zip(_NAMES, body, strict=True))), *one.completed()]
    return json.dumps(turns if lines else [*one.counts(), hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in turns).encode("utf-8", "surrogatepass")).hexdigest()])


def _pieces(sorted_rows: DataFrame, lines: bool) -> DataFrame:
    """Two rows a piece: its matrix, to be met from the last piece to the first, and its turns, from the first to the last.

    A conversation of one piece that begins and ends within a task's rows is settled there: one row of phase 2, so that its texts
    need not travel again. Only a task's first and last conversation, and those of several pieces, go on as pieces.
    """
    kind = dict(sorted_rows.dtypes)["id"]

    def run(batches):
        base, made, piece, out, schema = TaskContext.get().partitionId() << 40, 0, None, [], None
        size, whole = 0, False  # whole: the piece is the first of its conversation, which is not the task's first
        for b in batches:
            schema = schema or pa.schema([("id", b.schema.field("id").type), ("phase", pa.int32()), ("place", pa.int64()), ("runs", pa.string()), ("moves", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")], ("ends", pa.string()), *[(c, pa.int64()) for c in ("first", "last", "turns")]])
            for own, turn, role, text, n, fault in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if piece is None or piece.own != own or piece.chars >= PIECE_CHARS or len(piece.roles) >= PIECE_TURNS:
                    if piece and whole and piece.own != own:
                        out.append((piece.own, 2, 0, _settled(piece, lines), *[None] * 11))
                        size += len(out[-1][3])
                    elif piece:
                        out += piece.rows(base + made)
                        size += piece.chars
                    whole = piece is not None and piece.own != own
                    made, piece = made + 1, _Piece(own)
                    if size >= PIECE_CHARS or len(out) >= PIECE_TURNS:
                        yield _batch(out, schema)
                        out, size = [], 0
                if n:
                    piece.add(turn, role, text, n, fault)
        if piece:
            yield _batch(out + piece.rows(base + made), schema)

    return sorted_rows.mapInArrow(run, f"id {kind}, {_PIECE}")


class _Conversation:
    """What the pieces of one conversation come to, met in the order of _pieces()."""

    def __init__(self, own):
        self.own, self.togo, self.state, self.cost = own, [END], START, None
        self.faults, self.illegal, self.turns = {"blank": 0, "duplicate": 0, "truncated": 0}, 0, 0
        self.first = self.last = self.ends = None
        self.audit = []
        self.settled = None  # what _settled() has told of it

    def step(self, moves: list[int]) -> None:
        """The matrix of the next piece from the end."""
        self.togo.append(tuple(min(moves[4 * q + j] + g for j, g in enumerate(self.togo[-1])) for q in range(4)))

    def repaired(self, r: dict):
        """The turns (role, text, edit) that are left of the next piece from the start."""
        at_start = self.togo.pop()
        self.cost = at_start[START] if self.cost is None else self.cost
        for c in self.faults:
            self.faults[c] += r[c]
        self.illegal += r["illegal"]
        if r["ends"] is not None:
            first, last = r["ends"].split("\n")
            self.illegal += self.ends is not None and (self.ends, first) not in LEGAL
            self.ends = last
        if r["first"] is not None:
            self.turns += r["turns"] - (r["first"] == self.last)
            self.first, self.last = r["first"] if self.first is None else self.first, r["last"]
        runs = [tuple(map(int, x.split("*"))) for x in r["runs"].split(",")] if r["runs"] else []
        state = self.state
        letters, self.state = unroll(runs, state, self.togo[-1])
        self.audit.append(letters)
        symbols, texts = chain.from_iterable(repeat(s, n) for s, n in runs), zip(r["roles"], r["texts"], strict=True)
        for c in letters:
            if c == "I":
                state = FOLLOWS[state]
                yield ROLES[state], "", c
            elif next(symbols) != GONE:
                role, text = next(texts)
                if c == "K":
                    state = INITIALS.find(role[0]) + 1
                    yield role, text, c
                elif c == "R":
                    state = FOLLOWS[state]
                    yield ROLES[state], text, c

    def completed(self):
        """The turns that complete the pattern."""
        letters, _ = ended(self.state)
        self.audit.append(letters)
        for c in letters:
            self.state = FOLLOWS[self.state]
            yield ROLES[self.state], "", c

    def counts(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.audit)


def _met(batches):
    """Each conversation with its pieces' texts, one after another: (conversation, turns or None once it is complete)."""
    now = None

    def ended_one():
        if now and now.settled is None:
            yield now, now.completed()
        if now:
            yield now, None

    for b in batches:
        for r in b.to_pylist():
            if now is None or now.own != r["id"]:
                yield from ended_one()
                now = _Conversation(r["id"])
            if r["phase"] == 2:
                now.settled = json.loads(r["runs"])
            elif r["phase"]:
                yield now, now.repaired(r)
            else:
                now.step(r["moves"])
    yield from ended_one()


def _reports(batches):
    """A row of counts, audit and digest per conversation."""
    out, digest, empty, size, schema = [], hashlib.sha256(), True, 0, {}
    for now, turns in _met(map(_kept(schema), batches)):
        for role, text, _ in turns or ():
            digest.update((f"{role}:{text}" if empty else f"\n{role}:{text}").encode("utf-8", "surrogatepass"))
            empty = False
        if turns is None:
            out.append((now.own, *(now.settled or (*now.counts(), digest.hexdigest()))))
            digest, empty, size = hashlib.sha256(), True, size + 200 + len(out[-1][7])
            if size > PIECE_CHARS:
                yield _batch(out, _schema(schema, _REPORT))
                out, size = [], 0
    if out:
        yield _batch(out, _schema(schema, _REPORT))


def _turns(batches):
    """A row per turn that is left."""
    out, place, size, schema = [], 0, 0, {}
    for now, turns in _met(map(_kept(schema), batches)):
        for role, text, edit in (now.settled or ()) if turns is None else turns:
            out.append((now.own, place, role, text, edit))
            place, size = place + 1, size + 100 + len(text)
            if size > PIECE_CHARS:
                yield _batch(out, _schema(schema, _TURN))
                out, size = [], 0
        if turns is None:
            place = 0
    if out:
        yield _batch(out, _schema(schema, _TURN))


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_TURN = "turn long, role string, text string, edit string"


def _kept(types: dict):
    """Batches as they are, with the ids' type noted once."""

    def see(batch):
        types["id"] = batch.schema.field("id").type
        return batch

    return see


def _schema(types: dict, columns: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([("id", types["id"]), *[(c.split()[0], kinds[c.split()[1]]) for c in columns.split(", ")]])


def _streamed(turns: DataFrame, run, columns: str, id_col: str, turn_col: str, role_col: str, text_col: str, copies: Column | None) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    n = F.lit(1) if copies is None else copies
    there = lambda c: F.when(n > 0, c)
    rows = turns.select(F.col(id_col).alias("id"), there(F.col(turn_col).cast("long")).alias("turn"), F.coalesce(there(blank(role_col)), F.lit("")).alias("role"), F.coalesce(there(blank(text_col)), F.lit("")).alias("text"), n.cast("long").alias("n"))
    rows = _symbols(rows, rows.groupBy("id", "turn", "role", "text").agg(F.sum("n").alias("n")))
    width, order = tasks_for(turns.sparkSession), ["id", "turn", "role", "text"]
    pieces = _pieces(rows.repartitionByRange(width, *order).sortWithinPartitions(*order), run is _turns)
    met = pieces.repartition(width, "id").sortWithinPartitions("id", "phase", "place")
    return met.mapInArrow(run, f"id {dict(rows.dtypes)['id']}, {columns}").withColumnRenamed("id", id_col)


def repair(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None) -> DataFrame:
    """One row per conversation: id, ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Turns are taken by number (null first); those of one number by role and text. copies: how often a row is there (none: once); a conversation
    without any turn, all its rows at 0, gets zeros, an empty audit and the digest of nothing. Null roles and texts are one
    blank; a null id is a conversation of its own; repeated rows are duplicates. A turn's first fault counts. gaps are the
    numbers missing between the least and the greatest. An empty role has no initial: such a turn is given another role or goes.
    audit: the cheapest edits K(eep), R(erole), D(elete), I(nsert) in order, of several the least by ASCII; a turn of the pattern that is kept, given a
    role or inserted is a line ``role:text`` of what repaired_sha256 digests. An empty table gives no row; other columns are not read.
    """
    return _streamed(turns, _reports, _REPORT, id_col, turn_col, role_col, text_col, copies)


def repaired(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies: Column | None = None) -> DataFrame:
    """The turns that repair() leaves: id, ``turn`` from 0, ``role, text``, and the ``edit`` (K, R or I) that each comes from."""
    return _streamed(turns, _turns, _TURN, id_col, turn_col, role_col, text_col, copies)
