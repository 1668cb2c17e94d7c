"""Read the elements of large JSON arrays without loading any file whole.

A file that holds one array has no line structure to split by.  Here the text source splits it at
``}`` instead, so Hadoop's normal file splits apply and every piece is smaller than a record.
Whether a ``}`` is real depends on what comes before it: the open strings and braces of all
earlier text.  Array operations on whole batches reduce a piece to three small numbers: whether it
flips the string state, and its brace balance if it starts outside or inside a string.  Then

1. each split sums its numbers up for both possible start states (one small row per split) and
   notes the first and the last piece that ends at its lowest depth;
2. running sums over those rows give the state at the start of every split, so the lowest depth,
   and with it which pieces are part of an element that crosses into a neighbour;
3. the whole elements of a split are glued where they are read;
4. only the pieces of crossing elements are shuffled.  They are numbered by the rows of step 2.

Malformed input ends the job: unbalanced text, anything but a comma between elements, elements
that are not objects, text after the closing bracket.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One state row per input split.  Up to this many are sent to every task (about 100 bytes each).
MAX_BROADCAST_SPLITS = 200_000

_SPLIT = ["src_idx", "src_file", "block_start"]
_SIDE = "struct<balance: long, low: long, first: long, last: long, low_inner: long, first_inner: long, last_inner: long>"
_SUMMARY = (
    "src_idx int, src_file string, block_start long, file_size long, n_bytes long, parity int, "
    f"first_seq long, last_seq long, outside {_SIDE}, inside {_SIDE}"
)
_ELEMENT = "src_idx int, src_file string, block_start long, seq long, value string"

# What stands before the first element and before any other one.
_BEFORE_FIRST, _BEFORE_NEXT = (rf"^[ \t\r\n]*{sign}[ \t\r\n]*(?=\{{)" for sign in (r"\[", ","))
_FIRST, _NEXT = re.compile(_BEFORE_FIRST), re.compile(_BEFORE_NEXT)
_CLOSING, _EMPTY = re.compile(r"[ \t\r\n]*\][ \t\r\n]*"), re.compile(r"[ \t\r\n]*\[[ \t\r\n]*\][ \t\r\n]*")


def _numbers(values: pa.Array) -> list[np.ndarray]:
    """Of each piece: does it flip the string state, and the brackets it opens minus those it closes
    if it starts outside, or inside, a string.

    In valid JSON a backslash only occurs inside strings, so escaped quotes are known whatever the
    state before; each other quote is a real one.  No piece holds a closing brace.
    """
    n, text = len(values), values.buffers()[2]
    bounds = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + n + 1]
    data = np.frombuffer(text if text is not None else b"", np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    quote = data == ord('"')
    slashes = np.flatnonzero(data == ord("\\"))
    if len(slashes):
        piece = np.searchsorted(bounds, slashes, "right") - 1
        place = np.arange(len(slashes))
        opens = np.ones(len(slashes), bool)
        opens[1:] = (np.diff(slashes) != 1) | (np.diff(piece) != 0)
        # Of a row of backslashes every other one escapes what follows.
        escaping = (place - np.maximum.accumulate(np.where(opens, place, 0))) % 2 == 0
        quote[slashes[escaping & (slashes + 1 < bounds[piece + 1])] + 1] = False
    quotes = np.flatnonzero(quote)
    quotes_to = np.searchsorted(quotes, bounds)
    brackets = np.flatnonzero((data == ord("{")) | (data == ord("[")) | (data == ord("]")))
    piece = np.searchsorted(bounds, brackets, "right") - 1
    as_started = (np.searchsorted(quotes, brackets) - quotes_to[piece]) % 2 == 0
    step = np.where(data[brackets] == ord("]"), -1, 1)
    sides = [np.bincount(piece[at], step[at], n).astype(np.int64) for at in (as_started, ~as_started)]
    return [np.diff(quotes_to) % 2, *sides]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Cut batches into runs of one split."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file = batch.column("src_file").dictionary_encode().indices.to_numpy()
        block = batch.column("block_start").to_numpy()
        cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(block) != 0)) + 1
        for start, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            run = batch.slice(start, end - start)
            yield tuple(run.column(c)[0].as_py() for c in _SPLIT), run


def _walk(inside: int, depth: int, numbers: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """After each piece: is a string open, and how many braces and brackets are."""
    parity, if_outside, if_inside = numbers
    after = (inside + np.cumsum(parity)) % 2
    steps = np.where(after != parity, if_inside, if_outside) - (1 - after)
    return after, depth + np.cumsum(steps, dtype=np.int64)


class _Side:
    """Depths of one split, counted from its start, if it starts outside or inside a string."""

    def __init__(self, inside: int) -> None:
        self.inside, self.balance = inside, 0
        self.low = self.first = self.last = None

    def add(self, seq: np.ndarray, numbers: Sequence[np.ndarray]) -> None:
        after, depth = _walk(self.inside, self.balance, numbers)
        self.inside, self.balance = int(after[-1]), int(depth[-1])
        closed = after == 0
        if not closed.any():
            return
        low = int(depth[closed].min())
        at = seq[closed & (depth == low)]
        if self.low is None or low < self.low:
            self.low, self.first, self.last = low, int(at[0]), int(at[-1])
        elif low == self.low:
            self.last = int(at[-1])

    def row(self, seq: np.ndarray, numbers: Sequence[np.ndarray]) -> dict:
        """The side with its very last piece, and what was lowest before that one."""
        inner = {"low_inner": self.low, "first_inner": self.first, "last_inner": self.last}
        self.add(seq, numbers)
        return {"balance": self.balance, "low": self.low, "first": self.first, "last": self.last, **inner}


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split.  The last piece is held back: that of a file has no brace behind it."""
    key, row, sides, held = None, {}, [], None

    def closed() -> pa.RecordBatch:
        ends = {name: side.row(held[0], held[1:]) for name, side in zip(("outside", "inside"), sides)}
        whole = {**row, "last_seq": int(held[0][0]), **ends}
        return pa.RecordBatch.from_pylist([{n: whole[n] for n in _summary_type.names}], schema=_summary_type)

    for run_key, run in _runs(batches):
        values = run.column("value")
        numbers = [run.column("seq").to_numpy(), *_numbers(values)]
        if run_key != key:
            if held is not None:
                yield closed()
            key, sides, held = run_key, [_Side(0), _Side(1)], None
            row = {**dict(zip(_SPLIT, key)), "file_size": run.column("file_size")[0].as_py()}
            row |= {"n_bytes": 0, "parity": 0, "first_seq": int(numbers[0][0])}
        row["n_bytes"] += pc.sum(pc.binary_length(values)).as_py() + len(values)
        row["parity"] = (row["parity"] + int(numbers[1].sum())) % 2
        if held is not None:
            numbers = [np.concatenate(pair) for pair in zip(held, numbers)]
        held = [n[-1:] for n in numbers]
        if len(numbers[0]) > 1:
            for side in sides:
                side.add(numbers[0][:-1], [n[:-1] for n in numbers[1:]])
    if held is not None:
        yield closed()


_side_type = pa.struct([(n, pa.int64()) for n in ("balance", "low", "first", "last", "low_inner", "first_inner", "last_inner")])
_summary_type = pa.schema(
    [
        ("src_idx", pa.int32()),
        ("src_file", pa.string()),
        ("block_start", pa.int64()),
        ("file_size", pa.int64()),
        ("n_bytes", pa.int64()),
        ("parity", pa.int32()),
        ("first_seq", pa.int64()),
        ("last_seq", pa.int64()),
        ("outside", _side_type),
        ("inside", _side_type),
    ]
)


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole elements.  What comes in of a split begins and ends between two of them."""
    key, held, held_seq = None, [], 0
    inside, depth, at_start = 0, 0, False
    for run_key, run in _runs(batches):
        if run_key != key:
            key, held, inside = run_key, [], 0
            at_start = key[2] == 0
            depth = -1 if at_start else 0
        seq = run.column("seq").to_numpy()
        texts = run.column("value").to_pylist()
        after, depths = _walk(inside, depth, _numbers(run.column("value")))
        inside, depth = int(after[-1]), int(depths[-1])
        ends = np.flatnonzero((after == 0) & (depths == 0))
        n = len(texts)
        if seq[-1] == run.column("closing_seq")[0].as_py():
            if not (_EMPTY if at_start and n == 1 and not held else _CLOSING).fullmatch(texts[-1]):
                raise ValueError(f"malformed end of a JSON array: {texts[-1][:80]!r}")
            ends, n = ends[ends < n - 1], n - 1
        starts, values, begin = [], [], 0
        for end in ends.tolist():
            starts.append(held_seq if held else seq[begin])
            body = "}".join([*held, *texts[begin : end + 1]])
            before = (_FIRST if at_start else _NEXT).match(body)
            if not before:
                raise ValueError(f"malformed JSON array of objects near {body[:80]!r}")
            values.append(body[before.end() :] + "}")
            held, begin, at_start = [], end + 1, False
        if begin < n:
            held_seq = held_seq if held else int(seq[begin])
            held += texts[begin:n]
        constants = [pa.repeat(pa.scalar(v, t), len(values)) for v, t in zip(key, (pa.int32(), pa.string(), pa.int64()))]
        columns = [*constants, pa.array(starts, pa.int64()), pa.array(values, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["src_idx", "src_file", "block_start", "seq", "value"])


def _byte_size(setting: str) -> int:
    units = {"k": 10, "m": 20, "g": 30, "t": 40}
    text = setting.strip().lower().rstrip("b")
    return int(text[:-1]) << units[text[-1]] if text[-1] in units else int(text)


def _most_splits(spark: SparkSession, text: DataFrame) -> int:
    """An upper bound for the number of input splits, from the file listing alone."""
    total = int(str(text._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    largest = _byte_size(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    open_cost = _byte_size(spark.conf.get("spark.sql.files.openCostInBytes"))
    per_core = total // max(spark.sparkContext.defaultParallelism, 1)
    split = max(min(largest, max(open_cost, per_core)), 1)
    return total // split + 1 + len(text.inputFiles())


def _split_states(pieces: DataFrame) -> DataFrame:
    """Which pieces of each split belong to whole elements; checks that each file is balanced.

    Pieces up to ``head_to`` end element ``n_before`` of those that cross, pieces from ``tail_from`` begin
    the next one; piece ``closing_seq`` closes the array.
    """
    file = "partition by src_idx, src_file"
    before = f"({file} order by block_start rows between unbounded preceding and 1 preceding)"
    never = f"{2**63 - 1}L"
    started = pieces.mapInArrow(_summaries, _SUMMARY).selectExpr(
        "*",
        f"coalesce(sum(parity) over {before}, 0) % 2 = 1 as in_string",
        f"lead(block_start) over ({file} order by block_start) is null as is_last",
    )
    sided = started.selectExpr("*", "if(in_string, inside, outside) as side").selectExpr(
        "*",
        f"coalesce(sum(side.balance) over {before}, 0) as depth",
        "if(is_last, side.low_inner, side.low) as low",
        "if(is_last, side.first_inner, side.first) as first",
        "if(is_last, side.last_inner, side.last) as last",
    )
    # Splits begin behind a "}".  With only the array open, that one ended an element.
    placed = sided.selectExpr(
        "*",
        "coalesce(depth + low = 1, false) as has_end",
        "not in_string and depth = if(block_start = 0, 0, 1) as between",
    ).selectExpr(
        "*",
        f"if(between, -1L, if(has_end, first, {never})) as head_to",
        f"if(has_end, last + 1, if(between, first_seq, {never})) as tail_from",
    )
    # The last piece holds the closing bracket and has no "}" behind it.
    sound = F.expr(
        f"sum(side.balance) over ({file}) = -1 and sum(parity) over ({file}) % 2 = 0 "
        f"and sum(n_bytes) over ({file}) = file_size + 1 "
        "and coalesce(depth + low, 1) >= 1 and (not is_last or tail_from = last_seq)"
    )
    problem = F.raise_error(F.concat(F.lit("malformed JSON array in "), F.col("src_file")))
    return placed.select(
        *_SPLIT,
        F.when(sound, F.col("head_to")).otherwise(problem.cast("long")).alias("head_to"),
        "tail_from",
        F.expr("if(is_last, last_seq, -1L)").alias("closing_seq"),
        "first_seq",
        F.expr(f"coalesce(sum(int(not is_last and tail_from <= last_seq)) over {before}, 0)").alias("n_before"),
    )


def _crossing(pieces: DataFrame) -> DataFrame:
    """The elements that lie in several splits."""
    start = F.col("pieces")[0]
    body = F.array_join(F.col("pieces")["value"], "}")
    before = F.when(start["opens_file"], F.lit(_BEFORE_FIRST)).otherwise(F.lit(_BEFORE_NEXT))
    problem = F.raise_error(F.concat(F.lit("malformed JSON array of objects in "), F.col("src_file"))).cast("string")
    element = F.when(body.rlike(_BEFORE_FIRST) | body.rlike(_BEFORE_NEXT), F.regexp_replace(body, before, F.lit("")))
    part = F.struct("block_start", "seq", F.expr("block_start = 0 and seq = first_seq").alias("opens_file"), "value")
    return (
        pieces.filter("(seq <= head_to or seq >= tail_from) and seq != closing_seq")
        .withColumn("element", F.expr("n_before + int(seq > head_to)"))
        .groupBy("src_idx", "src_file", "element")
        .agg(F.array_sort(F.collect_list(part)).alias("pieces"))
        .select(
            "src_idx",
            "src_file",
            start["block_start"].alias("block_start"),
            start["seq"].alias("seq"),
            F.concat(F.coalesce(element, problem), F.lit("}")).alias("value"),
        )
    )


def read_array_elements(spark: SparkSession, paths: Sequence[str], src_idx: int = 0) -> DataFrame:
    """One row ``(src_idx, src_file, block_start, seq, value)`` per element, ``value`` its text."""
    text = spark.read.option("lineSep", "}").text(list(paths))
    pieces = text.select(
        F.lit(src_idx).alias("src_idx"),
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value"),
    )
    states = _split_states(pieces)
    broadcast = _most_splits(spark, text) <= MAX_BROADCAST_SPLITS
    # Both uses read all columns of the states, so that Spark works them out once.
    placed = pieces.drop("file_size").join(F.broadcast(states) if broadcast else states.hint("merge"), _SPLIT)
    inner = placed.filter("seq > head_to and (seq < tail_from or seq = closing_seq)")
    if not broadcast:
        # Splits are small, so that shuffle is even; the sort brings pieces back in order.
        inner = inner.sortWithinPartitions(*_SPLIT, "seq")
    return inner.mapInArrow(_elements, _ELEMENT).unionByName(_crossing(placed))
