"""Repair of the turn order of conversations by weighted interval parsing.

The grammar of a good conversation is ``(s?(ua)+)?`` over the initials of its roles. Its repair grammar in Chomsky normal
form has one nonterminal for each pair of places (before, after) in that pattern: a span of rows is one rule of edits for
a single row, or the pair of two adjacent spans that meet at a place. Inserted turns read no row; their closure is put on
both sides of every single row. A cell holds the cheapest (cost, audit) of each nonterminal of its span. Every split of a
span gives the same cells, because the place at which two spans meet is part of their nonterminals, so spans are combined
bottom-up with one split each: one row, two, four, and so on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from fieldtide.llm.common import stored
from fieldtide.operators import ordered

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
PART = 4096  # rows of one conversation that are worked on together
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# Places in the pattern: before anything, after the system turn, after a user turn, after an assistant turn.
PLACES = 4
MOVES = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ENDS = (0, 3)

Cell = tuple[tuple[tuple[int, str] | None, ...], ...]


# -- parsing ---------------------------------------------------------------------------------


def combined(left: Cell, right: Cell) -> Cell:
    """The cheapest (cost, audit) of each pair of places over two adjacent spans; equal costs go by audit."""
    rows = []
    for row in left:
        best: list[tuple[int, str] | None] = [None] * PLACES
        for middle, one in enumerate(row):
            if one is None:
                continue
            for end, two in enumerate(right[middle]):
                if two is not None:
                    both = (one[0] + two[0], one[1] + two[1])
                    if best[end] is None or both < best[end]:
                        best[end] = both
        rows.append(tuple(best))
    return tuple(rows)


def _cell(edits: Iterable[tuple[int, int, int, str]]) -> Cell:
    best: list[list[tuple[int, str] | None]] = [[None] * PLACES for _ in range(PLACES)]
    for start, end, cost, letter in edits:
        if best[start][end] is None or (cost, letter) < best[start][end]:
            best[start][end] = (cost, letter)
    return tuple(map(tuple, best))


def _insertions() -> Cell:
    """Any number of inserted turns, none included; more than the pattern has places is never cheaper."""
    nothing = [(p, p, 0, "") for p in range(PLACES)]
    one = _cell(nothing + [(p, q, INSERT, "I") for role in "ua" for p, q in MOVES[role].items()])
    whole = one
    for _ in range(PLACES):
        whole = combined(whole, one)
    return whole


CLOSURE = _insertions()


def _single(symbol: str) -> Cell:
    """One row: s, u, a or x (another role), in upper case where its text is truncated; d for a row that has to go."""
    edits = [(p, p, DELETE, "D") for p in range(PLACES)]
    if symbol != "d":
        more = TRUNCATED if symbol.isupper() else 0
        edits += [(p, q, KEEP + more, "K") for p, q in MOVES.get(symbol.lower(), {}).items()]
        edits += [(p, q, REROLE + more, "R") for role in "ua" for p, q in MOVES[role].items()]
    return combined(combined(CLOSURE, _cell(edits)), CLOSURE)


SINGLE = {symbol: _single(symbol) for symbol in "suaxSUAXd"}


@lru_cache(maxsize=1 << 16)
def _short(symbols: str) -> Cell:
    half = len(symbols) // 2
    return SINGLE[symbols] if half == 0 else combined(_short(symbols[:half]), _short(symbols[half:]))


def parse(symbols: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of the rows, the ASCII-least audit of equal costs."""
    if not symbols:
        return 0, ""
    cells = [_short(symbols[i:i + 8]) for i in range(0, len(symbols), 8)]
    while len(cells) > 1:
        cells = [combined(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return min(found for found in (cells[0][0][end] for end in ENDS) if found is not None)


def plans(symbols: str, audit: str, part: int = PART) -> list[str]:
    """The audit with roles, cut after every ``part`` rows: u and a insert a turn, K keeps a row, D deletes it, U and A
    give it the role user or assistant."""
    out, place, row = [""], 0, 0
    pieces: list[str] = []
    for letter in audit:
        if letter != "I" and row and row % part == 0 and len(out) <= row // part:
            out[-1] = "".join(pieces)
            pieces = []
            out.append("")
        if letter == "D":
            pieces.append("D")
        elif letter == "K":
            pieces.append("K")
            place = MOVES[symbols[row].lower()][place]
        else:
            role = "a" if place == 2 else "u"
            pieces.append(role if letter == "I" else role.upper())
            place = MOVES[role][place]
        row += letter != "I"
    out[-1] = "".join(pieces)
    return out


PARSED = StructType([StructField("cost", LongType()), StructField("audit", StringType()), StructField("plans", ArrayType(StringType()))])


@F.pandas_udf(PARSED)
def _parsed(symbols: pd.Series) -> pd.DataFrame:
    out = []
    for row in symbols:
        cost, audit = parse(row)
        out.append((cost, audit, plans(row, audit)))
    return pd.DataFrame(out, columns=["cost", "audit", "plans"])


# -- applying the edits ----------------------------------------------------------------------

ROLES = {"u": "user", "a": "assistant"}


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, edit, role, text) of the repaired turns, from plans and rows in order; one row is held at a time."""
    plan, at = "", 0
    for batch in batches:
        for conv, new, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv", "plan", "role", "text"))):
            if new is not None:
                plan, at = new, 0
            else:
                edit = plan[at]
                at += 1
                if edit != "D":
                    yield conv, edit, ROLES.get(edit.lower(), role), text
            # Turns that are inserted before the next row, or at the end.
            while at < len(plan) and plan[at] in ROLES:
                yield conv, "I", ROLES[plan[at]], ""
                at += 1


def _repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv_type, last, place, out, size = None, (), 0, [], 0

    def first_type(items):
        nonlocal conv_type
        for batch in items:
            conv_type = batch.schema.field("conv").type
            yield batch

    def made() -> pa.RecordBatch:
        columns = list(zip(*out))
        edits = ["R" if e in "UA" else e for e in columns[2]]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], conv_type), pa.array(columns[1], pa.int64()), pa.array(edits, pa.string()),
             pa.array(columns[3], pa.string()), pa.array(columns[4], pa.string())], names=["conv", "place", "edit", "role", "text"])

    for conv, edit, role, text in _walk(first_type(batches)):
        place = place + 1 if last == (conv,) else 1
        last = (conv,)
        out.append((conv, place, edit, role, text))
        size += len(text) + 1
        if size > 1 << 22 or len(out) >= 10_000:
            yield made()
            out, size = [], 0
    if out:
        yield made()


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each conversation's ``role:text`` lines, read as a stream."""
    conv_type, current, state, out = None, None, None, []

    def first_type(items):
        nonlocal conv_type
        for batch in items:
            conv_type = batch.schema.field("conv").type
            yield batch

    def made() -> pa.RecordBatch:
        convs, hashes = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(convs, conv_type), pa.array(hashes, pa.string())], names=["conv", "repaired_sha256"])

    for conv, _, role, text in _walk(first_type(batches)):
        if state is None or conv != current:
            if state is not None:
                out.append((current, state.hexdigest()))
                if len(out) >= 10_000:
                    yield made()
                    out = []
            current, state = conv, hashlib.sha256(f"{role}:{text}".encode())
        else:
            state.update(f"\n{role}:{text}".encode())
    if state is not None:
        out.append((current, state.hexdigest()))
        yield made()


# -- conversations ---------------------------------------------------------------------------


class Repair:
    """The faults of conversations and their cheapest repair.

    Rows are ordered by turn (null first), ties by role and text; a null role or text is one space; a null conversation
    is one conversation. A row's first fault counts: blank, duplicate (role and text seen earlier in the conversation),
    truncated (its last visible character ends no sentence). Rows that repeat are duplicates of the first. An empty table
    gives empty results. Other columns are ignored, whatever their names.

    Conversations of any length are numbered, compared and read in blocks. What one task holds of a conversation is a
    letter per row, from which its audit is parsed; its texts only pass through the task that hashes them in order.
    """

    def __init__(self, turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"):
        said = turns.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                            F.coalesce(F.col(text), F.lit(" ")).alias("text"))
        seen = F.rtrim("text", F.lit(BLANKS))
        said = said.select(
            "*", F.left("role", F.lit(1)).alias("initial"), (seen == "").alias("blank"), (~F.right(seen, F.lit(1)).isin(".", "!", "?")).alias("cut"),
            F.xxhash64("role", "text").alias("h1"), F.xxhash64("text", "role", F.lit(1)).alias("h2"))
        order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
        rows = ordered.numbered(said, ["conv"], order, number="pos", previous={"turn_before": "turn", "initial_before": "initial"})
        self.rows = stored(rows.withColumn("part", F.floor((F.col("pos") - 1) / PART)), "repair-rows")
        self._parse()

    def _parse(self) -> None:
        small = self.rows.drop("role", "text")
        again = ordered.numbered(small, ["conv", "h1", "h2"], [F.col("pos")], number="nth")
        fault = F.when(F.col("blank"), "blank").when(F.col("nth") > 1, "duplicate").when(F.col("cut"), "truncated")
        marked = again.withColumn("fault", fault)
        plain = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("x")
        symbol = F.when(F.col("fault").isin("blank", "duplicate"), "d").when(F.col("fault") == "truncated", F.upper(plain)).otherwise(plain)
        pair = F.concat("initial_before", "initial")
        first = F.col("pos") == 1
        of = lambda name: F.sum((F.col("fault") == name).cast("long"))
        # Two steps, so that no more than PART rows are sorted at once.
        parts = marked.groupBy("conv", "part").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", symbol.alias("symbol")))), lambda s: s["symbol"]), "").alias("symbols"),
            F.min("turn").alias("low"), F.max("turn").alias("high"),
            F.sum((F.col("turn").isNotNull() & (first | ~F.col("turn").eqNullSafe(F.col("turn_before")))).cast("long")).alias("turns"),
            *[F.coalesce(of(n), F.lit(0).cast("long")).alias(n) for n in ("blank", "duplicate", "truncated")],
            F.sum((~first & ~pair.isin("su", "ua", "au")).cast("long")).alias("illegal"),
        )
        whole = parts.groupBy("conv").agg(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "symbols"))), lambda s: s["symbols"]), "").alias("symbols"),
            F.coalesce(F.max("high") - F.min("low") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps"),
            *[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated", "illegal")],
        )
        parsed = whole.withColumn("parsed", _parsed("symbols")).select("*", "parsed.*").drop("parsed", "symbols")
        self.parsed = stored(parsed, "repair-plans")

    def report(self) -> DataFrame:
        """conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256."""
        kind = self.rows.schema["conv"].dataType.simpleString()
        digests = self._ordered().mapInArrow(_digests, f"conv {kind}, repaired_sha256 string")
        digests = digests.withColumnRenamed("conv", "_conv")
        out = self.parsed.join(digests, F.col("conv").eqNullSafe(F.col("_conv")), "left")
        # A conversation of which nothing is left is the empty text.
        return out.select("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                          F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))

    def repaired(self) -> DataFrame:
        """conv, place, edit (K, R or I), role, text: the turns of the repaired conversations."""
        kind = self.rows.schema["conv"].dataType.simpleString()
        return self._ordered().mapInArrow(_repaired, f"conv {kind}, place long, edit string, role string, text string")

    def _ordered(self) -> DataFrame:
        """Every part's plan, then its rows, conversation by conversation."""
        none = F.lit(None).cast("string")
        plan = self.parsed.select("conv", F.posexplode("plans").alias("part", "plan"))
        plan = plan.select("conv", F.col("part").cast("long").alias("part"), F.lit(0).cast("long").alias("pos"), "plan", none.alias("role"), none.alias("text"))
        rows = self.rows.select("conv", F.col("part").cast("long").alias("part"), F.col("pos").cast("long").alias("pos"), none.alias("plan"), "role", "text")
        tasks = int(self.rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return plan.unionByName(rows).repartition(tasks, "conv").sortWithinPartitions("conv", "part", "pos")
