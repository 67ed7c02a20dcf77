"""Repair of conversation structure at least cost.

Turns are kept, given another role or deleted, and empty turns inserted, until the role initials
read ``(s?(ua)+)?``.  That is a least path in a directed acyclic graph: its nodes are (rows read,
state of that pattern), its edges an edit of the next row with the inserts before it.  A path's
weight is one integer.  High digits carry the cost; below them every edit of the path has one
fixed-width digit, the first edit the highest, in the ASCII order of the letters (D, I, K, R), and
unused positions at the end are zero.  So the integer minimum is the cheapest path and, among
equals, the one whose letters are least in ASCII order; no other comparison is needed.

Two paths to a node have both just read the same row, so neither's letters begin the other's and
their order stays whatever follows.  That keeps the state small: one integer and one running digest
of the repaired text per pattern state.  After a block of rows, paths too costly ever to be the least
end, and leading digits that all others share are final and move from the integers to the audit, so a
conversation's length does not make the integers long.

Rows travel once to find repeated texts (by conversation, role and text, so a long conversation is spread)
and once to be read in order.  A conversation is then streamed through a task, batch by batch, never held;
its audit and digest are single values, which only one task can write.

Defined results
    null role or text    one space, as is a null id or turn in the key of the damage
    null turn            before all others; outside the gaps
    null conversation    a conversation of its own
    ties                 rows of one turn are ordered by role, then text
    repeated rows        rows of their own, so all but the first are duplicates
    empty text           blank
    very long text       hashed as it passes
    empty table          no rows
    clashing columns     only conv_id, turn, role and text are read
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from storelake.llm.common import WORD

# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
LETTER = {digit: letter for letter, digit in DIGIT.items()}
DIGIT_BITS = 3
ROLES = {"u": "user", "a": "assistant"}
# The pattern's states: nothing yet, after the system turn, after a user turn, after an answer.
START, SYSTEM, USER, ANSWER = range(4)
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ANSWER, (ANSWER, "u"): USER}
ENDS = (START, ANSWER)
# More inserts in a row come back to a state they left.
MOST_INSERTS = 2
# What follows one state can follow any other by at most one more insert and one more delete (a system turn
# that can no longer be kept), so a path this much costlier than another is never the least.
CATCH_UP = DELETE + INSERT
BLOCK_ROWS = 64

FAULTS = ("blank", "duplicate", "truncated")


# -- damage and faults --------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copy) after the damage; a dropped row stays with a null role and text."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    harm = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), harm.alias("harm"))
    gone = F.col("harm") == 0
    text = F.when(F.col("harm") == 1, "").when(F.col("harm") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.when(F.col("harm") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id",
        "turn",
        F.when(~gone, F.when(F.col("harm") == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(~gone, text).alias("text"),
        F.explode(copies).alias("copy"),
    )


def faulted(rows: DataFrame) -> DataFrame:
    """Each row's first fault, as its number in ``FAULTS``."""
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first()))
    fault = (
        F.when(~F.col("text").rlike(WORD), 0)
        .when(F.col("seen") > 1, 1)
        .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), 2)
    )
    return rows.withColumn("seen", seen).select("conv_id", "turn", "role", "text", "seen", fault.cast("long").alias("fault"))


# -- the least path -----------------------------------------------------------------------


def _inserts() -> dict[int, list[tuple[str, tuple[str, ...], int]]]:
    """Per state, what may be inserted there: letters, roles, and the state after them."""
    ways = {}
    for state in range(4):
        ways[state], at, roles = [("", (), state)], state, ()
        for n in range(MOST_INSERTS):
            initial = "a" if at == USER else "u"
            at, roles = NEXT[at, initial], (*roles, initial)
            ways[state].append(("I" * (n + 1), roles, at))
    return ways


INSERTS = _inserts()


@dataclass(frozen=True)
class Edge:
    """One row's edit with the inserts before it; ``role`` None keeps the row's own, ``shown`` False deletes it."""

    state: int
    after: int
    cost: int
    letters: str
    before: bytes
    role: bytes | None
    shown: bool

    @property
    def digits(self) -> int:
        number = 0
        for letter in self.letters:
            number = number << DIGIT_BITS | DIGIT[letter]
        return number


def _edges(initial: str, fault: int | None) -> list[Edge]:
    """All edits of a row with this role initial and fault."""
    found = []
    for state in range(4):
        for inserted, roles, at in INSERTS[state]:
            before = "".join(f"{ROLES[r]}:\n" for r in roles).encode()
            cost = INSERT * len(inserted)
            extra = TRUNCATED if fault == 2 else 0
            if fault not in (0, 1):
                if (at, initial) in NEXT:
                    found.append(Edge(state, NEXT[at, initial], cost + extra, inserted + "K", before, None, True))
                for new, role in ROLES.items():
                    if (at, new) in NEXT:
                        found.append(Edge(state, NEXT[at, new], cost + REROLE + extra, inserted + "R", before, role.encode(), True))
            found.append(Edge(state, at, cost + DELETE, inserted + "D", before, None, False))
    return found


EDGES = {(initial, fault): _edges(initial, fault) for initial in ("s", "u", "a", "") for fault in (None, 0, 1, 2)}
# One row adds at most this many digits.
ROW_DIGITS = MOST_INSERTS + 1


@dataclass
class Path:
    """The least path to a state: its weight, its number of digits in it, and the digest of the repaired text.

    Every repaired turn is hashed with a line feed behind it; the one behind the last is held back."""

    weight: int = 0
    letters: int = 0
    digest: object = field(default_factory=hashlib.sha256)
    pending: bytes = b""

    def shown(self, text: bytes) -> tuple[object, bytes]:
        digest = self.digest.copy()
        digest.update(self.pending + text[:-1])
        return digest, text[-1:]


class Repair:
    """Edits of one conversation, row by row."""

    def __init__(self) -> None:
        self.paths = {START: Path()}
        self.room = self.rows = 0
        self.settled: list[str] = []

    def _widen(self) -> None:
        """Move digits all paths share to the audit, and make room for the next block of rows."""
        bits = DIGIT_BITS * self.room
        most = min(p.weight >> bits for p in self.paths.values()) + CATCH_UP
        self.paths = {state: p for state, p in self.paths.items() if p.weight >> bits <= most}
        paths = self.paths.values()
        low = (1 << bits) - 1
        shared = min(p.letters for p in paths)
        first = next(iter(paths)).weight & low
        for p in paths:
            differ = (first ^ (p.weight & low)).bit_length()
            shared = min(shared, (bits - differ) // DIGIT_BITS)
        if shared:
            self.settled.append(_read(first >> (bits - DIGIT_BITS * shared), shared))
        used = max(p.letters for p in paths) - shared
        unused = bits - DIGIT_BITS * (shared + used)
        room = used + BLOCK_ROWS * ROW_DIGITS
        for p in paths:
            cost, digits = p.weight >> bits, (p.weight & ((1 << DIGIT_BITS * used) - 1 << unused)) >> unused
            p.weight = (cost << DIGIT_BITS * room) | (digits << DIGIT_BITS * BLOCK_ROWS * ROW_DIGITS)
            p.letters -= shared
        self.room = room

    def read(self, role: str, text: str, fault: int | None) -> None:
        if self.rows % BLOCK_ROWS == 0:
            self._widen()
        self.rows += 1
        best: dict[int, tuple[int, Edge]] = {}
        for edge in EDGES[role[:1] if role[:1] in ("s", "u", "a") else "", fault]:
            path = self.paths.get(edge.state)
            if path is None:
                continue
            place = DIGIT_BITS * (self.room - path.letters - len(edge.letters))
            weight = path.weight + (edge.cost << DIGIT_BITS * self.room) + (edge.digits << place)
            if edge.after not in best or weight < best[edge.after][0]:
                best[edge.after] = weight, edge
        body = b":" + text.encode() + b"\n"
        paths = {}
        for state, (weight, edge) in best.items():
            old = self.paths[edge.state]
            said = edge.before + ((role.encode() if edge.role is None else edge.role) + body if edge.shown else b"")
            digest, pending = old.shown(said) if said else (old.digest, old.pending)
            paths[state] = Path(weight, old.letters + len(edge.letters), digest, pending)
        self.paths = paths

    def end(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the repaired conversation."""
        if self.room == 0 or any(p.letters + MOST_INSERTS > self.room for p in self.paths.values()):
            self._widen()
        found = []
        for state, path in self.paths.items():
            for inserted, roles, at in INSERTS[state]:
                if at not in ENDS:
                    continue
                weight, letters = path.weight + (INSERT * len(inserted) << DIGIT_BITS * self.room), path.letters
                for letter in inserted:
                    letters += 1
                    weight += DIGIT[letter] << DIGIT_BITS * (self.room - letters)
                found.append((weight, letters, state, roles))
        weight, letters, state, roles = min(found, key=lambda f: f[0])
        digest = self.paths[state].digest
        if roles:
            digest, _ = self.paths[state].shown("".join(f"{ROLES[r]}:\n" for r in roles).encode())
        cost, digits = divmod(weight, 1 << DIGIT_BITS * self.room)
        return cost, "".join(self.settled) + _read(digits >> DIGIT_BITS * (self.room - letters), letters), digest.hexdigest()


def _read(digits: int, n: int) -> str:
    """The ``n`` letters of a number; octal, as a letter has three bits."""
    return "".join(LETTER[int(d)] for d in f"{digits:o}") if n else ""


# -- whole conversations ------------------------------------------------------------------


class Conversation:
    """Counts and repair of one conversation, whose rows come in order."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.faults = [0, 0, 0]
        self.illegal = 0
        self.turns: list[int] | None = None
        self.distinct = 0
        self.last: str | None = None
        self.repair = Repair()

    def read(self, turn: int | None, role: str | None, text: str | None, fault: int | None) -> None:
        if role is None:
            return
        if fault is not None:
            self.faults[fault] += 1
        if turn is not None:
            if self.turns is None or turn != self.turns[1]:
                self.distinct += 1
            self.turns = [turn if self.turns is None else self.turns[0], turn]
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        self.repair.read(role, text, fault)

    def result(self) -> tuple:
        gaps = 0 if self.turns is None else self.turns[1] - self.turns[0] + 1 - self.distinct
        return (self.conv_id, gaps, *self.faults, self.illegal, *self.repair.end())


RESULT = ("gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256")


def _streamed(kind: pa.DataType):
    """Sorted rows to one row per conversation; a conversation may go on in the next batch."""
    layout = pa.schema([("conv_id", kind)] + [(n, pa.string() if n in RESULT[-2:] else pa.int64()) for n in RESULT])

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in layout]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, layout)], schema=layout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: Conversation | None = None
        for batch in batches:
            done = []
            for conv_id, *row in zip(*(batch[n].to_pylist() for n in ("conv_id", "turn", "role", "text", "fault"))):
                if open_ is None or open_.conv_id != conv_id:
                    if open_ is not None:
                        done.append(open_.result())
                    open_ = Conversation(conv_id)
                open_.read(*row)
            if done:
                yield batch_of(done)
        if open_ is not None:
            yield batch_of([open_.result()])

    return run


def repaired(rows: DataFrame) -> DataFrame:
    """(conv_id, faults, cost, audit, digest) of conversations as they are; null roles mark dropped rows."""
    kind = rows.schema["conv_id"].dataType
    layout = f"conv_id {kind.simpleString()}, " + ", ".join(f"{n} {'string' if n in RESULT[-2:] else 'long'}" for n in RESULT)
    # ``seen`` last: of equal rows the first is the one that is no duplicate.
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen"]
    turns = faulted(rows.withColumn("turn", F.col("turn").cast("long")))
    return turns.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_streamed(to_arrow_type(kind)), layout)
