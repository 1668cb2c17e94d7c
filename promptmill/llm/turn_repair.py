"""Repair of the role structure of conversations by weighted interval parsing.

Edits turn the roles of a conversation into ``(s?(ua)+)?``: a row is kept, gets the role user or
assistant, or is deleted, and empty user or assistant turns are inserted anywhere.  The cheapest
edits are found by bottom-up (CYK) parsing with a grammar in Chomsky normal form:

* A nonterminal ``[p, q]`` stands for edits of a span that lead from state p to state q of what has
  come out so far: nothing yet, after a system, a user, an assistant turn.
* ``[p, q] -> [p, r] [r, q]`` are the binary rules; ``[p, q] -> row`` the edits of one row.
* Insertions derive the empty span; their closure is put around every row once, so that no rule has
  an empty side.
* A cell holds the smallest (cost, audit) of its nonterminal; the audit has one letter for each edit.

Cells are filled by span length.  A nonterminal names the states at both ends of its span, so every
derivation can be cut at any place inside, and one split of a span gives the same cell as all of
them: spans of 1, 2, 4, ... rows are enough and n rows take n - 1 combinations.  Equal costs and
equal beginnings of audits never meet (an audit that goes on with insertions costs more), so the
smallest audit of a span is made of the smallest audits of its parts.

Rows are dealt by ranges of (conversation, turn), so a conversation of any size is cut by place.  A
task finishes the conversations that lie inside its range.  Of the others (its first and last one,
and any of more than ``MOST_ROWS`` rows or ``MOST_CHARS`` characters) it writes the rows out; these are
parsed in blocks of ``BLOCK_ROWS`` rows, by (conversation, part), then by conversation, as cells without
text.  Only the hash of the repaired text, which cannot be computed in pieces, reads the rows of such
a conversation one after the other in one task, as a stream.

Defined cases: nulls in role and text are one space, and in the key of the damage; rows of null turn
come first; rows of one turn stand in the order of role and text; equal rows are counted before they
are dealt; an empty role, like any role that does not begin with s, u or a, cannot be kept; rows of
null conv_id are one conversation; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import batched

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import in_order, runs
from ..session import materialize

MOST_ROWS = 4096
MOST_CHARS = 16 << 20
BLOCK_ROWS = 512

NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
#: States: nothing yet, after s, after u, after a.  What a role leads to from each.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
NONTERMINALS = [(0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3)]
RULES = [
    [(NONTERMINALS.index((p, r)), NONTERMINALS.index((r, q))) for r in range(4) if (p, r) in NONTERMINALS and (r, q) in NONTERMINALS]
    for p, q in NONTERMINALS
]
ROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
FINE, BLANK, CUT_OFF = 0, 1, 2

Cell = tuple[int, str] | None
Cells = tuple[Cell, ...]


def combine(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two parts, by the binary rules."""
    cells = []
    for ways in RULES:
        best: Cell = None
        for a, b in ways:
            x, y = left[a], right[b]
            if x is None or y is None:
                continue
            cost = x[0] + y[0]
            if best is None or cost <= best[0]:
                found = (cost, x[1] + y[1])
                if best is None or found < best:
                    best = found
        cells.append(best)
    return tuple(cells)


def bottom_up(parts: list, join):
    """Parts joined by span length: neighbours in pairs until one is left."""
    while len(parts) > 1:
        parts = [join(*pair) if len(pair) == 2 else pair[0] for pair in batched(parts, 2)]
    return parts[0]


def _cells(edits: dict[tuple[int, int], tuple[int, str]]) -> Cells:
    return tuple(edits.get(n) for n in NONTERMINALS)


@cache
def insertions() -> Cells:
    """The closure of the empty span: nothing, or turns inserted until nothing gets cheaper."""
    step = {(p, p): (0, "") for p in range(4)}
    for role in NAMES:
        step |= {(p, q): (INSERT, "I") for p, q in NEXT[role].items()}
    closure = _cells(step)
    while (longer := combine(closure, closure)) != closure:
        closure = longer
    return closure


@cache
def row_cells(initial: str, fault: int, duplicate: bool) -> Cells:
    """Cells of one row: its edits between insertions."""
    edits = {(p, p): (DELETE, "D") for p in range(4)}
    if fault != BLANK and not duplicate:
        extra = TRUNCATED if fault == CUT_OFF else 0
        for role in NAMES:
            edits |= {(p, q): (ROLE + extra, "R") for p, q in NEXT[role].items()}
        edits |= {(p, q): (extra, "K") for p, q in NEXT.get(initial, {}).items()}
    return combine(combine(insertions(), _cells(edits)), insertions())


def repeated(cells: Cells, times: int) -> Cells:
    """Cells of ``times`` equal rows one after the other."""
    whole = insertions()
    while times:
        if times & 1:
            whole = combine(whole, cells)
        cells, times = combine(cells, cells), times >> 1
    return whole


@dataclass(slots=True)
class Span:
    """What is known of some rows that follow each other."""

    cells: Cells
    blank: int
    duplicate: int
    truncated: int
    illegal: int
    first: str
    last: str
    low: int | None
    high: int | None
    turns: int


def row_span(turn: int | None, initial: str, fault: int, copies: int, seen: bool) -> Span:
    """``copies`` equal rows, of which the first is no duplicate unless ``seen``."""
    blank = copies if fault == BLANK else 0
    again = 0 if fault == BLANK else copies if seen else copies - 1
    cells = row_cells(initial, fault, seen)
    if copies > 1:
        cells = combine(cells, repeated(row_cells(initial, fault, True), copies - 1))
    cut_off = int(fault == CUT_OFF and not seen)
    return Span(cells, blank, again, cut_off, copies - 1, initial, initial, turn, turn, int(turn is not None))


def join(a: Span, b: Span) -> Span:
    met = a.high is not None and a.high == b.low
    return Span(
        combine(a.cells, b.cells),
        a.blank + b.blank,
        a.duplicate + b.duplicate,
        a.truncated + b.truncated,
        a.illegal + b.illegal + (a.last + b.first not in LEGAL),
        a.first,
        b.last,
        b.low if a.low is None else a.low,
        a.high if b.high is None else b.high,
        a.turns + b.turns - met,
    )


def outcome(span: Span | None) -> dict:
    """The counts of a whole conversation and its cheapest edits."""
    if span is None:
        return dict(gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit="")
    ends = [span.cells[NONTERMINALS.index((0, q))] for q in (0, 3)]
    cost, audit = min(c for c in ends if c is not None)
    gaps = 0 if span.low is None else span.high - span.low + 1 - span.turns
    return dict(
        gaps=gaps,
        blank=span.blank,
        duplicate=span.duplicate,
        truncated=span.truncated,
        illegal=span.illegal,
        cost=cost,
        audit=audit,
    )


class Repaired:
    """Applies an audit to rows that come in order; gives the parts of the repaired text."""

    def __init__(self, audit: str):
        self.audit, self.at, self.role = audit, 0, "u"

    def _written(self, role: str, line: str) -> str:
        self.role = "a" if role == "u" else "u"
        return line

    def inserted(self) -> Iterator[str]:
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield self._written(self.role, NAMES[self.role] + ":")

    def row(self, role: str, text: str, copies: int) -> Iterator[str]:
        for _ in range(copies):
            yield from self.inserted()
            letter = self.audit[self.at]
            self.at += 1
            if letter == "K":
                yield self._written(role[0], f"{role}:{text}")
            elif letter == "R":
                yield self._written(self.role, f"{NAMES[self.role]}:{text}")


class Digest:
    """SHA-256 of lines joined by a newline."""

    def __init__(self):
        self.sha, self.some = hashlib.sha256(), False

    def add(self, lines: Iterable[str]) -> None:
        for line in lines:
            self.sha.update(("\n" if self.some else "").encode() + line.encode())
            self.some = True


def _digest(audit: str, rows: Iterable[tuple]) -> str:
    repaired, digest = Repaired(audit), Digest()
    for _, role, text, copies, *_ in rows:
        digest.add(repaired.row(role, text, copies))
    digest.add(repaired.inserted())
    return digest.sha.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with the faults of the contract; ``copies`` is 0 for a
    dropped row, which only tells that the conversation exists, and 2 for a repeated one."""

    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    dropped = case == 0
    text = F.when(dropped | (case == 1), F.lit("")).when(case == 2, F.translate(spaced("text"), ".!?", ""))
    return rows.select(
        "conv_id",
        F.when(~dropped, F.col("turn").cast("long")).alias("turn"),
        F.when(dropped, F.lit("")).when(case == 4, F.lit("user")).otherwise(spaced("role")).alias("role"),
        text.otherwise(spaced("text")).alias("text"),
        F.when(dropped, F.lit(0)).when(case == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"),
    )


_BLANKS = " \t\n\x0b\x0c\r"
_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_COUNTS = [f.split()[0] for f in _RESULT.split(", ")]


def _parse_partition(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Results of the conversations inside a sorted partition, rows of the others."""
    part = TaskContext.get().partitionId()
    out: list[dict] = []
    rows: list[tuple] = []
    spans: list[Span] = []
    seen: set[bytes] = set()
    chars, place, is_open, conv = 0, 0, True, None
    started = False

    def give_out() -> None:
        nonlocal place
        for turn, role, text, copies, fault, again in rows:
            out.append(
                dict(conv_id=conv, part=part, place=place, turn=turn, role=role, text=text, copies=copies, fault=fault, seen=again)
            )
            place += 1
        rows.clear()
        spans.clear()

    def finish() -> None:
        span = bottom_up(spans, join) if spans else None
        found = outcome(span)
        found["repaired_sha256"] = _digest(found["audit"], rows)
        out.append(dict(conv_id=conv, **found))
        rows.clear()
        spans.clear()

    def flush() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_pylist(out, schema)
        out.clear()
        return batch

    for is_new, run in runs(batches):
        if is_new:
            if started:
                give_out() if is_open else finish()
            # The first conversation may have begun before this partition.
            is_open, started = not started, True
            conv = run.column(0)[0].as_py()
            chars, place = 0, 0
            seen.clear()
        for begin in range(0, len(run), BLOCK_ROWS):
            some = run.slice(begin, BLOCK_ROWS)
            for turn, role, text, copies, fault in zip(*(some.column(i).to_pylist() for i in range(1, 6))):
                if not copies:
                    # A dropped row: only an open conversation needs the news that it exists.
                    if is_open and not rows:
                        rows.append((None, "", "", 0, FINE, False))
                    continue
                again = False
                if fault != BLANK:
                    key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
                    again = key in seen
                    seen.add(key)
                rows.append((turn, role, text, copies, fault, again))
                chars += len(text)
                if not is_open:
                    spans.append(row_span(turn, role[:1], fault, copies, again))
            if len(rows) >= MOST_ROWS or chars >= MOST_CHARS:
                is_open = True
            if is_open:
                give_out()
                chars = 0
            if len(out) >= BLOCK_ROWS:
                yield flush()
    # The last conversation may go on behind this partition.
    if started:
        give_out()
        # One whose rows were all dropped has none to give out; the mark tells of it.
        if not place:
            out.append(dict(conv_id=conv, part=part, place=0, role="", text="", copies=0, fault=FINE, seen=False))
    if out:
        yield flush()


_SPAN = (
    "cells array<struct<cost:long,audit:string>>, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, low long, high long, turns long"
)


def _as_row(span: Span) -> dict:
    fields = {f: getattr(span, f) for f in Span.__slots__}
    fields["cells"] = [None if c is None else {"cost": c[0], "audit": c[1]} for c in span.cells]
    return fields


def _as_span(row: dict) -> Span:
    cells = tuple(None if c is None else (int(c["cost"]), c["audit"]) for c in row["cells"])
    return Span(cells, *(row[f] for f in Span.__slots__[1:]))


def _joined(spans: list[Span], head: dict, schema: pa.Schema) -> pa.Table:
    rows = [{**head, **_as_row(bottom_up(spans, join))}] if spans else []
    return pa.Table.from_pylist(rows, schema)


def _open_conversations(pieces: DataFrame, conv_type: str) -> DataFrame:
    """Results of the conversations whose rows were written out."""
    # Seen in an earlier part; within a part that is known already, so a group has a row a part.
    key = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    fresh = pieces.filter((F.col("copies") > 0) & ~F.col("seen") & (F.col("fault") != BLANK))
    met = fresh.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("place").alias("_place"), key.alias("_key"))
    first = met.groupBy(F.col("_conv").alias("conv"), F.col("_key").alias("key")).agg(F.min("_part").alias("first"), F.count("*").alias("n"))
    same = F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("key") == F.col("_key"))
    later = met.join(first.filter("n > 1"), same).filter(F.col("_part") > F.col("first")).select("_conv", "_part", "_place")
    at = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("part") == F.col("_part")) & (F.col("place") == F.col("_place"))
    rows = pieces.join(later, at, "left")
    again = (F.col("seen") | F.col("_place").isNotNull()).alias("seen")
    rows = rows.select("conv_id", "part", "place", "turn", "role", "text", "copies", "fault", again)
    rows = materialize(rows, "open-turns")

    def parse(key: tuple, block: pa.Table) -> pa.Table:
        block = block.sort_by("place")
        names = ("turn", "initial", "fault", "copies", "seen")
        spans = [row_span(*row) for row in zip(*(block.column(n).to_pylist() for n in names))]
        return _joined(spans, dict(conv_id=key[0].as_py(), part=key[1].as_py(), block=key[2].as_py()), spans_arrow)

    def parse_parts(key: tuple, blocks: pa.Table) -> pa.Table:
        spans = [_as_span(r) for r in blocks.sort_by([("part", "ascending"), ("block", "ascending")]).to_pylist()]
        return _joined(spans, dict(conv_id=key[0].as_py(), part=blocks.column("part")[0].as_py(), block=0), spans_arrow)

    spans_schema = f"conv_id {conv_type}, part int, block long, {_SPAN}"
    spans_arrow = _arrow(pieces.sparkSession, spans_schema)
    slim = rows.filter("copies > 0").select(
        "conv_id", "part", F.floor(F.col("place") / BLOCK_ROWS).alias("block"), "place", "turn",
        F.substring("role", 1, 1).alias("initial"), "fault", "copies", "seen",
    )
    spans = slim.groupBy("conv_id", "part", "block").applyInArrow(parse, spans_schema)
    # Bounded by a part, then by the number of parts.
    spans = spans.groupBy("conv_id", "part").applyInArrow(parse_parts, spans_schema)
    spans = spans.groupBy("conv_id").applyInArrow(parse_parts, spans_schema)
    result_schema = f"conv_id {conv_type}, {_RESULT}"
    result_arrow = _arrow(pieces.sparkSession, result_schema)

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                conv = row.pop("conv_id")
                yield pa.RecordBatch.from_pylist([dict(conv_id=conv, **outcome(_as_span(row)))], result_arrow)

    found = spans.mapInArrow(results, result_schema)

    # The head of each conversation comes before its rows.
    blank = {"turn": "long", "role": "string", "text": "string", "copies": "long"}
    heads = found.select("*", F.lit(-1).alias("part"), F.lit(0).cast("long").alias("place"))
    heads = heads.select("*", *[F.lit(None).cast(t).alias(c) for c, t in blank.items()])
    lines = rows.select("conv_id", "part", "place", *blank, *[F.lit(None).cast(f.split()[1]).alias(f.split()[0]) for f in _RESULT.split(", ")])
    columns = ["conv_id", "part", "place", "role", "text", "copies", *_COUNTS]
    stream = lines.select(*columns).unionByName(heads.select(*columns))
    stream = stream.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    out_schema = f"{result_schema}, repaired_sha256 string"
    out_arrow = _arrow(pieces.sparkSession, out_schema)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head: dict | None = None
        repaired = digest = None

        def done() -> pa.RecordBatch:
            digest.add(repaired.inserted())
            return pa.RecordBatch.from_pylist([{**head, "repaired_sha256": digest.sha.hexdigest()}], out_arrow)

        for is_new, run in runs(batches):
            for begin in range(0, len(run), BLOCK_ROWS):
                for row in run.slice(begin, BLOCK_ROWS).to_pylist():
                    if is_new:
                        if head is not None:
                            yield done()
                        # Without a head all rows of the conversation were dropped.
                        counts = outcome(None) if row["audit"] is None else {c: row[c] for c in _COUNTS}
                        head, is_new = dict(conv_id=row["conv_id"], **counts), False
                        repaired, digest = Repaired(counts["audit"]), Digest()
                    if row["copies"]:
                        digest.add(repaired.row(row["role"], row["text"], row["copies"]))
        if head is not None:
            yield done()

    return stream.mapInArrow(hashed, out_schema)


def _arrow(spark, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], schema).schema)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, copies): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256."""
    conv_type = rows.schema["conv_id"].dataType.simpleString()
    last = F.substring(F.rtrim(F.col("text"), F.lit(_BLANKS)), -1, 1)
    fault = F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), CUT_OFF).otherwise(FINE)
    # Equal rows are counted before they are dealt, so that no range is full of them.
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    counted = counted.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))
    short = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64)]
    ordered = in_order(counted, short, [*short[:3], F.col("text")])
    schema = (
        f"conv_id {conv_type}, part int, place long, turn long, role string, text string, copies long, fault int, "
        f"seen boolean, {_RESULT}, repaired_sha256 string"
    )
    arrow = _arrow(rows.sparkSession, schema)
    parsed = materialize(ordered.mapInArrow(lambda batches: _parse_partition(batches, arrow), schema), "turns")
    done = parsed.filter("part is null").select("conv_id", *_COUNTS, "repaired_sha256")
    pieces = parsed.filter("part is not null").select("conv_id", "part", "place", "turn", "role", "text", "copies", "fault", "seen")
    return done.unionByName(_open_conversations(pieces, conv_type))
