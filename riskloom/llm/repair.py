"""Repair of conversations by iterative-deepening A*.

Rows of a conversation are taken by turn (nulls first), then role and the SHA-256 of the
text. An edit keeps a row (0), gives it the role user or assistant (1), deletes it (2) or
puts an empty user or assistant row before it (5); blank and repeated rows must go, and a
truncated row that stays costs 5 more. The cheapest edits whose role initials read
``(s?(ua)+)?`` are found by a depth-first search that tries edits in ASCII order of their
initials (D, I, K, R) within a cost bound, and raises the bound to the least cost that went
beyond it until a path is accepted: the first is the cheapest, and among those the
ASCII-least. The estimate of the cost to go is the sum of what each row costs on its own; a
table keeps, for each row and grammar state that failed, the cost to go that is known to be
needed, so no state is searched again within a bound that can't do.

Rows are dealt by ranges of (conversation, turn, role, hash), so a conversation of a third of
all rows lies on many tasks. Repeated rows are counted before; whether a text was
seen earlier in its conversation is an aggregate of (conversation, role, text). A task
reads its range in order, in pieces of at most ``PIECE_ROWS`` rows and ``PIECE_BYTES`` of text (or one row).
A conversation that lies in one piece is done there; the search runs from each grammar state
to each other for the pieces of others, and a second pass reads these pieces in order,
with the cheapest edits so far and a running hash for each of the four states. SHA-256 is
sequential, so that pass reads a conversation's pieces one after the other, but holds one at a time
and nothing of its texts.

Defined cases: a null role or text is one space; a null id is a conversation of its own;
turns that are null sort first and count for no gap; a row with ``copies`` 0 only names its
conversation; a role without a first letter is not kept; other columns are ignored; an empty
table gives an empty result. Gaps beyond the range of a long are its greatest value.
"""

from __future__ import annotations

import functools
import hashlib
import math
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import tidy
from riskloom.session import materialise

PIECE_ROWS = 256
PIECE_BYTES = 4 << 20
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPT = 4  # as a goal: the grammar's end, with rows added behind the last one
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}
ROLES = {USER: "user", ASSISTANT: "assistant"}
_KEPT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_GIVEN = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}


def _moves(code: str, state: int) -> Iterator[tuple[str, int, int, int]]:
    """(initial, rows used, next state, cost) of the edits before and of a row, in ASCII
    order. ``code`` is the role's initial (o: any other), upper case if truncated, x if the
    row must go, and empty behind the last row."""
    if code:
        yield "D", 1, state, 2
    yield "I", 0, _GIVEN[state], 5
    if code and code != "x":
        more = 5 if code.isupper() else 0
        kept = _KEPT.get(code.lower(), {}).get(state)
        if kept is not None:
            yield "K", 1, kept, more
        yield "R", 1, _GIVEN[state], 1 + more


@functools.lru_cache(maxsize=1 << 14)
def search(codes: str, entry: int = START, goal: int = ACCEPT) -> tuple[int, str] | None:
    """Cost and initials of the cheapest edits of rows ``codes`` from state ``entry`` to
    ``goal``, or None. Only for ``ACCEPT`` rows may be added behind the last one."""
    n = len(codes)
    if goal in (START, SYSTEM) and entry != goal and (entry != START or "s" not in codes.lower()) or goal < ACCEPT and not codes and entry != goal:
        return None
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + (2 if codes[i] == "x" or codes[i].isupper() else codes[i] == "o")
    needed: dict[tuple[int, int], float] = {}  # of states that failed
    path: list[str] = []

    def accepted(i: int, state: int, left: float) -> bool:
        if goal < state and goal < USER:
            needed[i, state] = math.inf  # no edit leads back
        if needed.get((i, state), least[i]) > left:
            return False
        if i == n and (state in (START, ASSISTANT) if goal == ACCEPT else state == goal):
            return True
        rest = math.inf
        for initial, used, after, cost in _moves(codes[i] if i < n else "", state) if i < n or goal == ACCEPT else ():
            path.append(initial)
            if accepted(i + used, after, left - cost):
                return True
            path.pop()
            rest = min(rest, cost + needed.get((i + used, after), least[i + used]))
        needed[i, state] = rest
        return False

    bound: float = least[0]
    while not accepted(0, entry, bound):
        bound = needed[0, entry]
    return int(bound), "".join(path)


def edited(audit: str, state: int, rows: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Role and text of the rows that ``audit`` makes of ``rows``, from a grammar state."""
    out, i = [], 0
    for initial in audit:
        if initial == "K":
            role = rows[i][0]
            state = _KEPT[role[0]][state]
        elif initial != "D":
            state = _GIVEN[state]
            role = ROLES[state]
        if initial != "D":
            out.append((role, "" if initial == "I" else rows[i][1]))
        i += initial != "I"
    return out


class _Piece:
    """Some rows of a conversation in order, and what is counted over them."""

    def __init__(self, conv: object, number: int) -> None:
        self.conv, self.number = conv, number
        self.rows: list[tuple[str, str]] = []
        self.codes: list[str] = []
        self.bytes = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.head = self.tail = None  # initials of the first and the last row
        self.low = self.high = None  # first and last turn

    def add(self, turn: int | None, role: str, text: str, fault: str, times: int) -> None:
        initial = role[:1]
        if self.tail is not None:
            self.illegal += self.tail + initial not in LEGAL
        else:
            self.head = initial
        self.illegal += times - 1  # no role follows itself
        self.tail = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn
        if fault:
            setattr(self, fault, getattr(self, fault) + times)
        gone = fault in ("blank", "duplicate")
        code = "x" if gone else initial if initial in _KEPT else "o"
        self.codes += [code.upper() if fault == "truncated" else code] * times
        self.rows += [("", "") if gone else (role, text)] * times
        self.bytes += 0 if gone else len(text)

    def full(self) -> bool:
        return len(self.codes) >= PIECE_ROWS or self.bytes >= PIECE_BYTES


class _Sum:
    """A conversation so far: counts, and for each grammar state the cheapest edits."""

    def __init__(self, conv: object, texts: bool) -> None:
        self.conv, self.texts = conv, texts
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.tail = self.low = self.high = None
        self.audit: list[str] = []  # what the edits of all states begin with
        #: cost, edits behind ``audit``, hash, rows, and the rows themselves as a chain of lists
        self.states: dict[int, tuple] = {START: (0, "", hashlib.sha256(), 0, None)}

    def _after(self, state: tuple, cost: int, own: str, rows: list[tuple[str, str]]) -> tuple:
        total, audit, digest, count, link = state
        digest = digest.copy()
        for k, (role, text) in enumerate(rows):
            digest.update(f"{chr(10) if count + k else ''}{role}:{text}".encode())
        return total + cost, audit + own, digest, count + len(rows), (link, rows) if self.texts else None

    def take(self, piece: _Piece, paths: dict[tuple[int, int], tuple[int, str]]) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + getattr(piece, name))
        if piece.head is not None:
            self.illegal += self.tail is not None and self.tail + piece.head not in LEGAL
            self.tail = piece.tail
        if piece.low is not None:
            self.turns += piece.turns - (piece.low == self.high)
            self.low = piece.low if self.low is None else self.low
            self.high = piece.high
        best: dict[int, tuple] = {}
        for (entry, goal), (cost, own) in paths.items():
            if entry in self.states:
                state = self.states[entry]
                found = (state[0] + cost, state[1] + own, entry, cost, own)
                if goal not in best or found < best[goal]:
                    best[goal] = found
        states = {goal: self._after(self.states[entry], cost, own, edited(own, entry, piece.rows)) for goal, (_, _, entry, cost, own) in best.items()}
        same = len(os.path.commonprefix([s[1] for s in states.values()]))
        if same:
            self.audit.append(next(iter(states.values()))[1][:same])
        self.states = {goal: (s[0], s[1][same:], *s[2:]) for goal, s in states.items()}

    def result(self) -> dict:
        """What is told of the whole conversation; its end may add rows."""
        ends = [self.states[ACCEPT]] if ACCEPT in self.states else []
        for goal, state in self.states.items():
            if goal != ACCEPT and (found := search("", goal)):
                ends.append(self._after(state, *found, edited(found[1], goal, [])))
        cost, tail, digest, _, link = min(ends, key=lambda s: s[:2])
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1)
        told = {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal}
        told |= {"cost": cost, "audit": "".join(self.audit) + tail, "repaired_sha256": digest.hexdigest()}
        if self.texts:
            made = []
            while link is not None:
                made.append(link[1])
                link = link[0]
            told["repaired"] = [{"role": r, "text": t} for rows in reversed(made) for r, t in rows]
        return told


_ONE = pa.struct([("role", pa.string()), ("text", pa.string())])
_TOLD = {c: pa.int64() for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")} | {"audit": pa.string(), "repaired_sha256": pa.string()}
_PATH = pa.struct([("entry", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "head", "tail", "number")
_PIECE = {"part": pa.int64(), "rows": pa.list_(_ONE), "paths": pa.list_(_PATH)}
_DDL = {pa.int64(): "bigint", pa.string(): "string", pa.list_(_ONE): "array<struct<role:string,text:string>>"}


def _told_fields(texts: bool) -> dict[str, pa.DataType]:
    return _TOLD | ({"repaired": pa.list_(_ONE)} if texts else {})


def _batch(conv_type: pa.DataType, fields: dict[str, pa.DataType], rows: list[dict]) -> pa.RecordBatch:
    types = {"conv": conv_type, **fields}
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], t) for c, t in types.items()], names=list(types))


def _flushed(made: Iterator[tuple[int, dict]], conv_type: pa.DataType, fields: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Batches of rows that come with about how many bytes they hold."""
    rows, held = [], 0
    for size, row in made:
        rows.append(row)
        held += size + 200
        if held > PIECE_BYTES:
            yield _batch(conv_type, fields, rows)
            rows, held = [], 0
    if rows:
        yield _batch(conv_type, fields, rows)


def _records(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[_Piece, bool, bool]]:
    """Pieces of a range, whether each may begin its conversation only elsewhere, and whether it
    is all there is of it."""
    piece, first, text, of = None, True, None, None
    for conv, turn, role, key, blank, cut, copies, body in _records(batches, ("conv", "turn", "role", "key", "blank", "cut", "copies", "text")):
        if copies is None:  # the text of a row where it is first seen; the row itself follows
            text, of = body, (conv, turn, role, key)
            continue
        if piece is not None and piece.conv != conv:
            yield piece, first, not first and not piece.number
            piece, first, = None, False
        if piece is None:
            piece = _Piece(conv, 0)
        seen = of != (conv, turn, role, key)
        while copies:
            if piece.full():
                yield piece, first, False
                piece = _Piece(conv, piece.number + 1)
            if blank or seen:
                times = min(copies, PIECE_ROWS - len(piece.codes))
                piece.add(turn, role, "", "blank" if blank else "duplicate", times)
            else:
                times = 1
                piece.add(turn, role, text, "truncated" if cut else "", 1)
                seen, text = True, None
            copies -= times
    if piece is not None:
        yield piece, first, False


def _scan(conv_type: pa.DataType, texts: bool):
    """Results of the conversations that lie in one piece, and the pieces of all others."""
    fields = _told_fields(texts) | _PIECE | {c: pa.string() if c in ("head", "tail") else pa.int64() for c in _COUNTS if c not in _TOLD}

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
        part = TaskContext.get().partitionId()
        for piece, first, whole in _pieces(batches):
            codes = "".join(piece.codes)
            if whole:
                total = _Sum(piece.conv, texts)
                total.take(piece, {(START, ACCEPT): search(codes)})
                yield piece.bytes if texts else len(codes), {"conv": piece.conv, **total.result()}
                continue
            entries = [START] if not first and not piece.number else range(4)
            paths = [(e, g, *found) for e in entries for g in range(4) if (found := search(codes, e, g))]
            row = {"conv": piece.conv, "part": part, **{c: getattr(piece, c) for c in _COUNTS}}
            row["rows"] = [{"role": r, "text": t} for r, t in piece.rows]
            row["paths"] = [dict(zip(("entry", "goal", "cost", "audit"), p, strict=True)) for p in paths]
            yield piece.bytes + 16 * len(codes), row

    return lambda batches: _flushed(made(batches), conv_type, fields), fields


def _fold(conv_type: pa.DataType, texts: bool):
    """Results of conversations of several pieces, which come in order."""
    fields = _told_fields(texts)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict]]:
        total = None
        for conv, rows, paths, *counts in _records(batches, ("conv", "rows", "paths", *_COUNTS)):
            if total is None or total.conv != conv:
                if total is not None:
                    yield 0, {"conv": total.conv, **total.result()}
                total = _Sum(conv, texts)
            piece = _Piece(conv, 0)
            for name, value in zip(_COUNTS, counts, strict=True):
                setattr(piece, name, value)
            piece.rows = [(r["role"], r["text"]) for r in rows]
            total.take(piece, {(p["entry"], p["goal"]): (p["cost"], p["audit"]) for p in paths})
        if total is not None:
            yield 0, {"conv": total.conv, **total.result()}

    return lambda batches: _flushed(made(batches), conv_type, fields), fields


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with ``copies``, damaged by a hash of conversation and turn:
    of twenty values, 0 drops a row, 1 empties its text, 2 takes its ends of sentences, 3
    repeats it, 4 makes it the user's. Nulls count as one space."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(told("text"), ".!?", "")).otherwise(told("text"))
    role = F.when(kind == 4, "user").otherwise(told("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def repair(rows: DataFrame, texts: bool = False) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, and ``copies``, how often a row
    stands there, 1 where the column lacks): gaps, blank, duplicate, truncated, illegal,
    cost, audit (initials of the edits), repaired_sha256 (of ``role:text`` by lines), and with
    ``texts`` the repaired rows, one value per conversation."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = rows.schema["conv_id"].dataType
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    here = rows.select(F.col("conv_id").alias("conv"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), copies.alias("copies"))
    bare = F.rtrim("text", F.lit(BLANKS))
    key, blank = F.unhex(F.sha2("text", 256)), bare == ""
    stays = F.col("copies") > 0
    named = [F.when(stays, c).alias(n) for c, n in [(F.col("turn"), "turn"), (F.col("role"), "role"), (key, "key"), (blank, "blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?"), "cut")]]
    slim = here.select("conv", *named, "copies").groupBy("conv", "turn", "role", "key", "blank", "cut").agg(F.sum("copies").alias("copies"))
    seen = here.where(stays & ~blank).groupBy("conv", "role", "text").agg(F.max(F.col("turn").isNull()).alias("untold"), F.min("turn").alias("turn"))
    first = seen.select("conv", F.when(~F.col("untold"), F.col("turn")).alias("turn"), "role", key.alias("key"), "text")
    order = ["conv", "turn", "role", "key"]
    both = slim.unionByName(first, allowMissingColumns=True).repartitionByRange(*order).sortWithinPartitions(*order, "copies")
    conv_type, conv_ddl = to_arrow_type(kind), kind.simpleString()
    ddl = lambda fields: ", ".join([f"conv {conv_ddl}", *(f"{c} {_DDL.get(t, 'array<struct<entry:int,goal:int,cost:bigint,audit:string>>')}" for c, t in fields.items())])
    scan, fields = _scan(conv_type, texts)
    found = materialise(both.mapInArrow(tidy(scan), ddl(fields)), "repair")
    fold, told = _fold(conv_type, texts)
    rest = found.where("part is not null").repartition("conv").sortWithinPartitions("conv", "part", "number").select("conv", "rows", "paths", *_COUNTS)
    done = found.where("part is null").select("conv", *told).union(rest.mapInArrow(tidy(fold), ddl(told)))
    return done.withColumnRenamed("conv", "conv_id")
