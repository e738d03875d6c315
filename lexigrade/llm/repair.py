"""Conversation structure repair: cheapest edits that make the roles of a conversation ``(s?(ua)+)?``, by Hirschberg's division.

The roles read so far leave one of four states (nothing, system, user, assistant). An edit keeps a turn (0), gives it
the role that must come next (1), deletes it (2) or inserts an empty turn before it (5); a turn that is cut off costs 5 more
unless it is deleted, blank turns and repeats must go. A forward vector of four costs from the start and a backward one
from the end meet at the middle turn; the crossing with the least sum is taken and both halves are solved alike, so memory is
linear in the turns and nothing but the codes of a half is read again.

Of equally cheap repairs the one whose audit (the initials of the edits) is least in ASCII wins. Audits that reach the same turn
in different states never begin with one another, because each ends with the edit that takes the turn. So a forward vector need only
carry the rank of its four audits beside their costs, and the crossing is the least (cost, rank).

No conversation is gathered: all turns are range-sorted, each task cuts its run into segments of bounded size, and a segment that may not
be a whole conversation also sends a 4 x 4 matrix of (cost, rank). A conversation's few matrices are chained to find the states between
its segments; then every segment is solved alone. Only the SHA-256 of a long conversation, a chain by definition, reads its pieces in
order, in one streaming pass that holds one piece.

Nulls in role or text count as one space, null turns come first, equal turns are ordered by role and text, a null ``conv_id`` is a
conversation of its own, and repeated rows are repeats. A conversation without a turn has zeros and an empty audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexigrade.session import write_stage

REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
WHITE = " \t\n\x0b\x0c\r"

# States by the last role: 0 nothing yet, 1 system, 2 user, 3 assistant.
NEXT = (2, 2, 3, 2)
ROLE = (None, None, "user", "assistant")
ACCEPT = (0, 3)
KEEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
FAR = 1 << 50

# Turns and characters of a segment.
SEGMENT_TURNS, SEGMENT_CHARS = 10_000, 4_000_000
# Conversations of at most this many turns are looked up by their codes.
SHORT = 16

Vector = tuple[tuple[int, int], ...]


def turn_code(initial: str, fault: str | None) -> int:
    """0 for a turn that must go, else its role (s, u, a, other) and whether it is cut off."""
    if fault in ("blank", "duplicate"):
        return 0
    return 1 + ("sua".find(initial) if initial and initial in "sua" else 3) + 4 * (fault == "truncated")


def _edits(code: int, state: int) -> dict[int, tuple[int, str]]:
    """Cheapest, then least, edits that take one turn from ``state`` into each state."""
    best: dict[int, tuple[int, str]] = {}
    extra = CUT_OFF if code > 4 else 0
    initial = "" if code == 0 else "sua "[(code - 1) % 4]
    for inserts in range(3):
        cost, letters = inserts * INSERT, "I" * inserts
        ways = [(state, cost + DELETE, letters + "D")]
        if code:
            ways.append((NEXT[state], cost + REROLE + extra, letters + "R"))
            if (state, initial) in KEEPS:
                ways.append((KEEPS[state, initial], cost + extra, letters + "K"))
        for to, price, edit in ways:
            best[to] = min(best.get(to, (FAR, "")), (price, edit))
        state = NEXT[state]
    return best


EDITS = tuple(tuple(_edits(code, state) for state in range(4)) for code in range(9))
#: Inserts that end a conversation left in each state.
CLOSING = ("", "II", "I", "")
CLOSED: tuple[int, ...] = tuple(INSERT * len(letters) for letters in CLOSING)


def only(state: int) -> tuple[int, ...]:
    return tuple(0 if s == state else FAR for s in range(4))


def forward(codes: Sequence[int], state: int) -> Vector:
    """(cost, rank of the audit) of reaching each state after all turns."""
    at: list[tuple[int, int]] = [(0, 0) if s == state else (FAR, 0) for s in range(4)]
    for code in codes:
        found: list[tuple[int, int, str]] = [(FAR, 0, "")] * 4
        for s, (cost, rank) in enumerate(at):
            if cost < FAR:
                for to, (price, letters) in EDITS[code][s].items():
                    found[to] = min(found[to], (cost + price, rank, letters))
        order = {key: i for i, key in enumerate(sorted({f[1:] for f in found if f[0] < FAR}))}
        at = [(f[0], order[f[1:]]) if f[0] < FAR else (FAR, 0) for f in found]
    return tuple(at)


def backward(codes: Sequence[int], after: Sequence[int]) -> tuple[int, ...]:
    """Cost of going from each state through all turns, when ``after`` are the costs from there on."""
    for code in reversed(codes):
        after = [min(price + after[to] for to, (price, _) in EDITS[code][s].items()) for s in range(4)]
    return tuple(min(cost, FAR) for cost in after)


def crossing(before: Vector, after: Sequence[int]) -> int:
    """The state of the cheapest crossing, of equally cheap ones that with the least audit."""
    return min(range(4), key=lambda s: (before[s][0] + after[s], before[s][1]))


def divide(codes: bytes, state: int, after: Sequence[int]) -> tuple[list[str], int]:
    """The edits that take each turn, and the state after the last one."""
    edits: list[str] = []
    parts = [(0, len(codes), state, tuple(after))] if codes else []
    while parts:
        low, high, start, ends = parts.pop()
        if high - low == 1:
            options = EDITS[codes[low]][start]
            state = min(options, key=lambda to: (options[to][0] + ends[to], options[to][1]))
            edits.append(options[state][1])
            continue
        middle = (low + high) // 2
        meet = crossing(forward(codes[low:middle], start), backward(codes[middle:high], ends))
        parts += [(middle, high, meet, ends), (low, middle, start, only(meet))]
    return edits, state


_known: dict[bytes, tuple[list[str], int]] = {}


def _divide_short(codes: bytes) -> tuple[list[str], int]:
    if codes not in _known:
        if len(_known) >= 1 << 16:
            _known.clear()
        _known[codes] = divide(codes, 0, CLOSED)
    return _known[codes]


# -- segments ---------------------------------------------------------------------------------------

_STATS = ("blank", "duplicate", "truncated", "illegal", "n_turns")
_SEGMENT = (
    "conv {conv}, part int, cut int, open boolean, codes binary, copies array<long>, roles array<string>, texts array<string>, "
    "first_initial string, last_initial string, first_turn long, last_turn long, "
    + ", ".join(f"{s} long" for s in _STATS)
    + ", matrix array<long>"
)


class _Segment:
    def __init__(self, conv: object, cut: int):
        # ``cut`` counts the segments of a task's run.
        self.conv, self.cut, self.chars = conv, cut, 0
        self.codes, self.copies, self.roles, self.texts = bytearray(), [], [], []
        self.initials: list[str] = []
        self.first_turn = self.last_turn = None
        self.stats = dict.fromkeys(_STATS, 0)

    def add(self, turn: int | None, role: str, text: str, n: int, seen: bool) -> None:
        stats, body = self.stats, text.rstrip(WHITE)
        fault = "blank" if not body else "duplicate" if seen else "truncated" if body[-1] not in ".!?" else None
        if fault == "blank":
            stats["blank"] += n
        else:
            stats["duplicate"] += n if seen else n - 1
            stats["truncated"] += fault == "truncated"
        initial = role[:1]
        if self.initials:
            stats["illegal"] += self.initials[-1] + initial not in ("su", "ua", "au")
        stats["illegal"] += n - 1
        if turn is not None and turn != self.last_turn:
            stats["n_turns"] += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        self.initials = [self.initials[0] if self.initials else initial, initial]
        self.codes.append(turn_code(initial, fault))
        # Copies beyond the first are repeats: deleted at once, before any insert.
        self.copies.append(n - 1)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text) + len(role)

    def row(self, part: int, open_: bool) -> tuple:
        matrix = [x for s in range(4) for pair in forward(self.codes, s) for x in pair] if open_ else None
        first, last = self.initials or (None, None)
        stats = [self.stats[s] for s in _STATS]
        return (
            self.conv, part, self.cut, open_, bytes(self.codes), self.copies, self.roles, self.texts, first, last, self.first_turn, self.last_turn,
            *stats, matrix,
        )


def _rows_out(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), schema)], schema=schema)


def _batched(rows: Iterable[tuple[tuple, int]], schema: pa.Schema, size: int = 1_000) -> Iterator[pa.RecordBatch]:
    """Batches of rows given with their number of characters."""
    held, chars = [], 0
    for row, n in rows:
        held.append(row)
        chars += n
        if len(held) == size or chars > SEGMENT_CHARS:
            yield _rows_out(held, schema)
            held, chars = [], 0
    if held:
        yield _rows_out(held, schema)


def _arrow(schema: str, conv: T.DataType) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    parsed = T.StructType.fromDDL(schema.format(conv=conv.simpleString()))
    return parsed, to_arrow_schema(parsed)


def collapse(turns: DataFrame, copies: str | None = None) -> DataFrame:
    """``(conv, turn, role, text, n, seen)``: equal rows as one with their number, and whether an earlier turn had the role and text.

    ``copies`` names a column with the number of times that a row stands there; 0 leaves only the conversation.
    """
    n = F.col(copies).cast("long") if copies else F.lit(1).cast("long")
    there = n > 0
    rows = turns.select(
        F.col("conv_id").alias("conv"),
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        F.when(there, F.coalesce(F.col("role"), F.lit(" "))).alias("role"),
        F.when(there, F.coalesce(F.col("text"), F.lit(" "))).alias("text"),
        n.alias("n"),
    )
    # Combined before the shuffle, so that copies of a row are no hot key.
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    keyed = rows.withColumn("digest", F.when(F.col("n") > 0, F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text"))))
    firsts = keyed.where("n > 0").groupBy(F.col("conv").alias("c"), F.col("digest").alias("d"))
    firsts = firsts.agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns")).where("turns > 1")
    marked = keyed.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    seen = F.col("turns").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first.turn"))
    return marked.select("conv", "turn", "role", "text", "n", seen.alias("seen"))


def segments(rows: DataFrame) -> DataFrame:
    """The range-sorted turns cut into stored segments of bounded size."""
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    spread = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    parsed, schema = _arrow(_SEGMENT, rows.schema["conv"].dataType)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()

        def closed() -> Iterator[tuple[tuple, int]]:
            # The first and the last conversation of a run may go on in another task's.
            segment, open_ = None, True
            for batch in batches:
                for conv, turn, role, text, n, seen in zip(*[c.to_pylist() for c in batch.columns]):
                    if segment is None:
                        segment = _Segment(conv, 0)
                    elif segment.conv != conv:
                        yield segment.row(part, open_), segment.chars
                        segment, open_ = _Segment(conv, segment.cut + 1), False
                    elif len(segment.codes) >= SEGMENT_TURNS or segment.chars >= SEGMENT_CHARS:
                        yield segment.row(part, True), segment.chars
                        segment, open_ = _Segment(conv, segment.cut + 1), True
                    if n:
                        segment.add(turn, role, text, n, seen)
            if segment is not None:
                yield segment.row(part, True), segment.chars

        yield from _batched(closed(), schema)

    return write_stage(spread.mapInArrow(cut, parsed), "repair-segments")


def _chain(conv: T.DataType):
    """The states between the segments of one conversation, from their matrices alone."""
    parsed, _ = _arrow("conv {conv}, part int, cut int, start int, end int", conv)

    def chain(table: pd.DataFrame) -> pd.DataFrame:
        table = table.sort_values(["part", "cut"])
        matrices = [[tuple((m[8 * s + 2 * t], m[8 * s + 2 * t + 1]) for t in range(4)) for s in range(4)] for m in table["matrix"]]
        after = [CLOSED]
        for matrix in reversed(matrices[1:]):
            after.append(tuple(min(min(matrix[s][t][0] + after[-1][t], FAR) for t in range(4)) for s in range(4)))
        state, starts, ends = 0, [], []
        for matrix, costs in zip(matrices, reversed(after)):
            starts.append(state)
            state = crossing(matrix[state], costs)
            ends.append(state)
        ends[-1] = -1
        return table[["conv", "part", "cut"]].assign(start=starts, end=ends)

    return chain, parsed


_PIECE = (
    "conv {conv}, part int, cut int, audit string, cost long, roles array<string>, texts array<string>, edits array<string>, "
    "first_initial string, last_initial string, first_turn long, last_turn long, " + ", ".join(f"{s} long" for s in _STATS)
)
_REST = ("first_initial", "last_initial", "first_turn", "last_turn", *_STATS)


class _Piece(NamedTuple):
    audit: str
    cost: int
    roles: list[str]
    texts: list[str]
    edits: list[str]


def solve(codes: bytes, copies: list[int], roles: list[str], texts: list[str], start: int = 0, end: int = -1) -> _Piece:
    """The edits of one segment and the turns that they leave; ``end`` -1 closes the conversation."""
    if end < 0 and start == 0 and len(codes) <= SHORT:
        edits, state = _divide_short(codes)
    else:
        edits, state = divide(codes, start, CLOSED if end < 0 else only(end))
    audit, cost, at = [], 0, start
    out: tuple[list[str], list[str], list[str]] = ([], [], [])

    def put(role: str, text: str, edit: str) -> None:
        for column, value in zip(out, (role, text, edit)):
            column.append(value)

    for i, letters in enumerate(edits):
        cost += INSERT * (len(letters) - 1) + DELETE * copies[i]
        audit.append(letters + "D" * copies[i])
        for letter in letters:
            if letter == "D":
                cost += DELETE
            elif letter == "K":
                at = KEEPS[at, roles[i][:1]]
                put(roles[i], texts[i], letter)
            else:
                at = NEXT[at]
                put(ROLE[at], "" if letter == "I" else texts[i], letter)
        cost += (CUT_OFF if codes[i] > 4 and letters[-1] != "D" else 0) + (REROLE if letters[-1] == "R" else 0)
    if end < 0:
        audit.append(CLOSING[state])
        cost += CLOSED[state]
        for _ in CLOSING[state]:
            at = NEXT[at]
            put(ROLE[at], "", "I")
    return _Piece("".join(audit), cost, *out)


def repair(turns: DataFrame, copies: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The repaired pieces of whole conversations and of those that were cut; see ``repaired_turns`` and ``report``.

    ``turns`` holds ``conv_id, turn, role, text``; other columns are ignored.
    """
    stored = segments(collapse(turns, copies))
    kind = stored.schema["conv"].dataType
    parsed, schema = _arrow(_PIECE, kind)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solved() -> Iterator[tuple[tuple, int]]:
            for batch in batches:
                names = batch.schema.names
                for row in zip(*[c.to_pylist() for c in batch.columns]):
                    r = dict(zip(names, row))
                    piece = solve(r["codes"], r["copies"], r["roles"], r["texts"], r["start"], r["end"])
                    yield (r["conv"], r["part"], r["cut"], *piece, *[r[c] for c in _REST]), sum(map(len, piece.texts))

        yield from _batched(solved(), schema)

    work = ("conv", "part", "cut", "codes", "copies", "roles", "texts", *_REST)
    whole = stored.where("not open").select(*work, F.lit(0).alias("start"), F.lit(-1).alias("end"))
    opened = stored.where("open")
    chain, chain_schema = _chain(kind)
    states = opened.select("conv", "part", "cut", "matrix").groupBy("conv").applyInPandas(chain, chain_schema).drop("conv")
    cut = opened.join(states.withColumnsRenamed({"part": "p", "cut": "c"}), (F.col("part") == F.col("p")) & (F.col("cut") == F.col("c")))
    return whole.mapInArrow(pieces, parsed), cut.select(*work, "start", "end").mapInArrow(pieces, parsed)


def repaired_turns(pieces: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``(conv_id, place, role, text, edit)``: the turns that are left; ``place`` orders those of a conversation."""
    both = pieces[0].unionByName(pieces[1])
    turn = F.posexplode(F.arrays_zip("roles", "texts", "edits")).alias("at", "turn")
    out = both.select("conv", "part", "cut", turn)
    return out.select(F.col("conv").alias("conv_id"), F.struct("part", "cut", "at").alias("place"), "turn.roles", "turn.texts", "turn.edits").toDF(
        "conv_id", "place", "role", "text", "edit"
    )


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = "conv_id {conv}, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"


class _Total:
    """One conversation, from its pieces in order; holds counts, the audit and a running hash, no text."""

    def __init__(self, conv: object):
        self.conv, self.counts, self.audit = conv, dict.fromkeys(_COUNTS, 0), []
        self.hash, self.started = hashlib.sha256(), False
        self.first = self.last = self.initial = None
        self.n_turns = 0

    def add(self, r: dict) -> None:
        for name in ("blank", "duplicate", "truncated", "illegal", "cost"):
            self.counts[name] += r[name]
        if r["first_initial"] is not None:
            if self.initial is not None:
                self.counts["illegal"] += self.initial + r["first_initial"] not in ("su", "ua", "au")
            self.initial = r["last_initial"]
        if r["first_turn"] is not None:
            self.n_turns += r["n_turns"] - (r["first_turn"] == self.last)
            self.first = r["first_turn"] if self.first is None else self.first
            self.last = r["last_turn"]
        self.audit.append(r["audit"])
        for role, text in zip(r["roles"], r["texts"]):
            self.hash.update((("\n" if self.started else "") + f"{role}:{text}").encode())
            self.started = True

    def row(self) -> tuple:
        if self.first is not None:
            self.counts["gaps"] = self.last - self.first + 1 - self.n_turns
        return self.conv, *self.counts.values(), "".join(self.audit), self.hash.hexdigest()


def report(pieces: tuple[DataFrame, DataFrame]) -> DataFrame:
    """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)`` of every conversation."""
    kind = pieces[0].schema["conv"].dataType
    parsed, schema = _arrow(_REPORT, kind)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ended() -> Iterator[tuple[tuple, int]]:
            total = None
            for batch in batches:
                names = batch.schema.names
                for row in zip(*[c.to_pylist() for c in batch.columns]):
                    r = dict(zip(names, row))
                    if total is None or total.conv != r["conv"]:
                        if total is not None:
                            yield total.row(), len(total.audit)
                        total = _Total(r["conv"])
                    total.add(r)
            if total is not None:
                yield total.row(), len(total.audit)

        yield from _batched(ended(), schema)

    whole, cut = pieces
    ordered = cut.repartition("conv").sortWithinPartitions("conv", "part", "cut")
    return whole.mapInArrow(totals, parsed).unionByName(ordered.mapInArrow(totals, parsed))
