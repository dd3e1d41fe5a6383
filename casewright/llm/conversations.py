"""Cheapest repair of conversations whose turns are missing, repeated, cut off or out of order.

A sound conversation is empty, or an optional system row and then pairs of a
user and an assistant row. Rows may be kept (K, free), given the role that is
due (R, 1), deleted (D, 2) and empty user or assistant rows inserted (I, 5); a
row kept or given a role although its text is cut off adds 5. Blank rows and
repeats must go. The audit of a conversation is the cheapest row of edits, of
equally cheap ones the first in the order of their letters.

Costs run from the end of a conversation to its start: a vector holds, for each
of the four states, the cheapest way to end soundly. Less its minimum such a
vector is one of a few, so the step over ``BLOCK`` rows is a table, built once:
(vector, block of row symbols) to (vector, cost added). A conversation is walked
block by block by lookup, which leaves the vectors at block ends; the edits are
then read forward, each block's inner vectors being worked out from its end. As
these are exact costs to the end, taking the first letter that loses nothing
gives the first audit among equals.

Spark deals conversations by id and sorts their rows by turn. The costs need one
byte a row; texts are not gathered but streamed past their conversation's audit
in a second sorted pass, whatever a conversation's length. Equal rows of a
conversation are counted before they travel, and repeats are found by the first
turn of each role and text, so neither a long conversation nor a text repeated
in all of them is collected.

Defined results: null turns come first; rows of the same turn are ordered by
role and the SHA-256 of their text; a null id is a conversation of its own; null
roles and texts are one blank; a role counts by its first letter, others than s,
u, a can only be replaced or deleted; a conversation none of whose rows are left
has zeros, an empty audit and the hash of the empty string; an empty table gives
an empty result; further columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Costs, the roles due in each state and the state that follows.
# States: nothing yet, after system, after user, after assistant.
# ---------------------------------------------------------------------------
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
DUE = ["user", "user", "assistant", "user"]
AFTER = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
END = (0, None, None, 0)
LEGAL = {"su", "ua", "au"}
INITIALS = "sua"
BLANKS = " \t\n\x0b\x0c\r"

#: Row symbols: initial s, u, a or another; the same cut off; a row that must go.
GONE, SYMBOLS = 8, 9
BLOCK = 4
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _due_state(q: int) -> int:
    return AFTER[q][DUE[q][0]]


def _with_insertions(costs: list[int]) -> list[int]:
    for _ in range(len(AFTER)):
        costs = [min(c, INSERT + costs[_due_state(q)]) for q, c in enumerate(costs)]
    return costs


def step(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs before a row from the costs after it."""
    before = []
    for q in range(len(AFTER)):
        ways = [after[q] + DELETE]
        if symbol != GONE:
            extra, initial = divmod(symbol, 4)
            ways.append(after[_due_state(q)] + REROLE + extra * TRUNCATED)
            kept = AFTER[q].get(INITIALS[initial]) if initial < len(INITIALS) else None
            if kept is not None:
                ways.append(after[kept] + extra * TRUNCATED)
        before.append(min(ways))
    return tuple(_with_insertions(before))


def last_costs() -> tuple[int, ...]:
    far = INSERT * 10
    return tuple(_with_insertions([far if c is None else c for c in END]))


class Tables:
    """All normalised vectors, the step over one symbol and the step over a block."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors = [last_costs()]
        number = {self.vectors[0]: 0}
        to, add = [], []
        for vector in self.vectors:  # grows while new vectors are found
            to.append([])
            add.append([])
            for symbol in range(SYMBOLS):
                costs = step(vector, symbol)
                low = min(costs)
                found = tuple(c - low for c in costs)
                if found not in number:
                    number[found] = len(self.vectors)
                    self.vectors.append(found)
                to[-1].append(number[found])
                add[-1].append(low)
        self.to, self.add = to, add
        one_to, one_add = np.array(to), np.array(add)
        codes = np.arange(SYMBOLS**block)
        at = np.repeat(np.arange(len(to))[:, None], len(codes), axis=1)
        cost = np.zeros_like(at)
        for place in range(block):  # the last symbol of a block has the lowest digit
            symbol = codes // SYMBOLS**place % SYMBOLS
            cost += one_add[at, symbol]
            at = one_to[at, symbol]
        self.block_to, self.block_add = at.tolist(), cost.tolist()

    @lru_cache(maxsize=1 << 18)
    def edits(self, end: int, symbols: bytes, state: int) -> tuple[str, int]:
        """Edits of a few rows that start in ``state`` and end before costs ``end``, and the state after them."""
        ends = [end]
        for symbol in reversed(symbols):
            ends.append(self.to[ends[-1]][symbol])
        letters = []
        for i, symbol in enumerate(symbols):
            after, at = ends[-2 - i], ends[-1 - i]
            before, rest, base = self.vectors[at], self.vectors[after], self.add[after][symbol]
            extra, initial = divmod(symbol, 4)
            while True:
                left = before[state] + base
                if rest[state] + DELETE == left:
                    letters.append("D")
                    break
                if before[_due_state(state)] + INSERT == before[state]:
                    letters.append("I")
                    state = _due_state(state)
                    continue
                kept = AFTER[state].get(INITIALS[initial]) if initial < len(INITIALS) else None
                if kept is not None and rest[kept] + extra * TRUNCATED == left:
                    letters.append("K")
                    state = kept
                else:
                    letters.append("R")
                    state = _due_state(state)
                break
        return "".join(letters), state

    def repair(self, symbols: bytes) -> tuple[int, str]:
        """Cost and audit of a conversation's row symbols."""
        size, head = self.block, len(symbols) % self.block
        blocks = [symbols[i : i + size] for i in range(head, len(symbols), size)]
        ends, cost = [0], 0
        for block in reversed(blocks):
            code = 0
            for symbol in block:
                code = code * SYMBOLS + symbol
            cost += self.block_add[ends[-1]][code]
            ends.append(self.block_to[ends[-1]][code])
        at = ends[-1]
        for symbol in reversed(symbols[:head]):
            cost += self.add[at][symbol]
            at = self.to[at][symbol]
        cost += self.vectors[at][0]
        state, parts = 0, []
        for block in [symbols[:head], *blocks]:
            part, state = self.edits(ends.pop(), block, state)
            parts.append(part)
        left = self.vectors[0][state] // INSERT
        return cost, "".join(parts) + "I" * left


@cache
def tables() -> Tables:
    return Tables()


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` with one row in four made faulty, chosen by the id and turn."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    return rows.select(
        "conv_id", "turn",
        F.when(fault == 4, "user").otherwise(text("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text("text"), ".!?", "")).otherwise(text("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _prepared(rows: DataFrame) -> DataFrame:
    """Rows with a digest in place of the text for all that needs its identity only; ``copies`` is 1 if absent."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(" "))
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"), copies.alias("copies"),
    )


def _symbol_rows(rows: DataFrame) -> DataFrame:
    """One row per different row of a conversation: its copies, whether blank, seen at an earlier turn, or cut off."""
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    counted = (
        rows.withColumn("blank", bare == "").withColumn("cut", ~F.right(bare, F.lit(1)).isin(".", "!", "?"))
        .groupBy("conv_id", "turn", "role", "digest")
        .agg(F.sum("copies").alias("copies"), F.bool_or("blank").alias("blank"), F.bool_or("cut").alias("cut"))
        .withColumn("key", F.struct("conv_id", "role", "digest"))  # structs join null ids, too
    )
    when = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    first = counted.filter("copies > 0").groupBy("key").agg(F.min(when).alias("first"))
    return counted.join(first, "key", "left").select(
        "conv_id", "turn", "role", "digest", "copies", "blank", "cut", F.coalesce(F.col("first") < when, F.lit(False)).alias("seen"),
    )


class _Conversation:
    """Figures and row symbols of one conversation while its rows pass by."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.symbols = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.last = None

    def add(self, turn, role, copies, blank, seen, cut) -> None:
        if copies == 0:
            return
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1  # a role beside itself
        self.last = initial
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies if seen else copies - 1
            self.truncated += bool(cut and not seen)
        place = INITIALS.find(initial) if initial else -1
        first = GONE if blank or seen else (place if place >= 0 else 3) + 4 * bool(cut)
        self.symbols.append(first)
        self.symbols += bytes([GONE]) * (copies - 1)

    def row(self) -> tuple:
        cost, audit = tables().repair(bytes(self.symbols))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv_id, min(gaps, 2**63 - 1), self.blank, self.duplicate, self.truncated, self.illegal, cost, audit


def _batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _schema(df: DataFrame, ddl: str) -> T.StructType:
    return T.StructType([T.StructField("conv_id", df.schema["conv_id"].dataType), *T.StructType.fromDDL(ddl).fields])


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation: gaps in its turns, faulty rows by first fault, illegal neighbours, cost and audit."""
    out = _schema(rows, ", ".join(f"{c} long" for c in COUNTS) + ", audit string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            now = None
            for batch in batches:
                names = ("conv_id", "turn", "role", "copies", "blank", "seen", "cut")
                for conv_id, *row in zip(*(batch.column(n).to_pylist() for n in names)):
                    if now is None or now.conv_id != conv_id:
                        if now is not None:
                            yield now.row()
                        now = _Conversation(conv_id)
                    now.add(*row)
            if now is not None:
                yield now.row()

        yield from _batches(each(), _arrow(out))

    dealt = _symbol_rows(_prepared(rows)).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "digest")
    return dealt.mapInArrow(run, out)


def _replayed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """``(True, heading, None)`` as a conversation begins, then ``(False, edit, row)`` for each row it has after its repair."""
    letters, at, state = "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(letters) and letters[at] == "I":
            yield False, "I", (DUE[state], "")
            at, state = at + 1, _due_state(state)

    for batch in batches:
        heads = batch.select(["conv_id", *COUNTS]).to_pylist() if any(k == 0 for k in batch.column("kind").to_pylist()) else None
        for i, (kind, role, text, copies) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("kind", "role", "text", "copies")))):
            if kind == 0:
                yield from inserted()
                letters, at, state = text, 0, 0
                yield True, heads[i] | {"audit": text}, None
                continue
            for _ in range(copies):
                yield from inserted()
                letter = letters[at]
                at += 1
                if letter == "D":
                    continue
                role = DUE[state] if letter == "R" else role
                state = AFTER[state][role[0]]
                yield False, letter, (role, text)
    yield from inserted()


def _with_headings(rows: DataFrame, found: DataFrame) -> DataFrame:
    """All rows of a conversation behind a heading with its figures and audit, in order."""
    ready = _prepared(rows).filter("copies > 0").withColumn("kind", F.lit(1))
    headings = found.withColumnRenamed("audit", "text").withColumn("kind", F.lit(0))
    both = headings.unionByName(ready, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")


def repair(rows: DataFrame) -> DataFrame:
    """The rows of all conversations after their repair: ``conv_id, position, edit, role, text``."""
    out = _schema(rows, "position long, edit string, role string, text string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            conv_id = position = None
            for begins, what, row in _replayed(batches):
                if begins:
                    conv_id, position = what["conv_id"], 0
                else:
                    yield conv_id, position, what, *row
                    position += 1

        yield from _batches(each(), _arrow(out))

    return _with_headings(rows, audits(rows)).mapInArrow(run, out)


def digest(rows: DataFrame) -> DataFrame:
    """The figures of ``audits`` and the SHA-256 of each repaired conversation, its ``role:text`` joined by line ends."""
    out = _schema(rows, ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            heading = seal = None
            empty = True
            for begins, what, row in _replayed(batches):
                if begins:
                    if heading is not None:
                        yield *heading.values(), seal.hexdigest()
                    heading, seal, empty = what, hashlib.sha256(), True
                else:
                    seal.update(("" if empty else "\n").encode() + f"{row[0]}:{row[1]}".encode())
                    empty = False
            if heading is not None:
                yield *heading.values(), seal.hexdigest()

        yield from _batches(each(), _arrow(out))

    return _with_headings(rows, audits(rows)).mapInArrow(run, out)
