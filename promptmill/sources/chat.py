"""Chat files: one conversation per JSON line, tolerant, with reasons for what is refused."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import MESSAGES_TYPE
from ..functions.text import py_strip
from ..functions.variants import as_array, as_text, is_object, let, with_strict_json
from .records import PROVENANCE, line_numbers, read_lines

MALFORMED, NON_OBJECT = "malformed", "non_object"
NO_MESSAGES, INVALID_MESSAGE = "no_messages", "invalid_message"


def _field_text(value: Column) -> Column:
    """Missing key: empty text.  JSON null: null."""
    return F.when(value.isNull(), F.lit("")).otherwise(as_text(value))


def _objects(items: Column) -> Column:
    """The items that are objects, as (role, content) structs of JSON values."""
    fields = F.transform(items, lambda m: F.try_variant_get(m, "$", "struct<role:variant,content:variant>"))
    return F.filter(fields, lambda m: m.isNotNull())


def _as_messages(objects: Column) -> Column:
    return F.transform(
        objects,
        lambda m: F.struct(
            _field_text(m["role"]).alias("role"), _field_text(m["content"]).alias("content")
        ),
    )


def normalize_messages(items: Column) -> Column:
    """``array<variant>`` to ``array<struct<role, content>>``; items that are no objects go."""
    return _as_messages(_objects(items))


def _conversation(rec: Column) -> Column:
    """The message items of one record: of the object's ``messages``, or the bare list itself."""
    return F.coalesce(F.try_variant_get(rec, "$.messages", "array<variant>"), as_array(rec))


def _outcome(
    reason: str | None, messages: Column, no_messages: bool = False, n_invalid: Column | None = None
) -> Column:
    return F.struct(
        F.lit("kept" if reason is None else "rejected").alias("status"),
        F.lit(reason).cast("string").alias("reason"),
        messages.cast(MESSAGES_TYPE).alias("messages"),
        F.lit(no_messages).alias("no_messages"),
        (F.lit(0) if n_invalid is None else n_invalid).alias("n_invalid"),
    )


def parse_chat(lines: DataFrame) -> DataFrame:
    """Sort every non-blank line into kept or rejected.

    Works on batch and streaming frames alike: no shuffle, one JSON parse per line.  Columns:
    the line's provenance, ``status`` (``kept``/``rejected``), ``reason`` of rejection,
    ``messages``, ``no_messages``, ``n_invalid`` (dropped message items) and, for rejected
    lines only, their text ``line``.
    """
    nothing = F.lit(None)

    def of_items(rec: Column, items: Column) -> Column:
        return F.when(
            items.isNotNull(),
            let(
                _objects(items),
                lambda objects: _outcome(
                    None, _as_messages(objects), n_invalid=F.size(items) - F.size(objects)
                ),
            ),
        ).otherwise(
            F.when(is_object(rec), _outcome(None, F.array(), no_messages=True)).otherwise(
                _outcome(NON_OBJECT, nothing)
            )
        )

    def outcome(rec: Column) -> Column:
        return F.when(rec.isNull(), _outcome(MALFORMED, nothing)).otherwise(
            let(_conversation(rec), lambda items: of_items(rec, items))
        )

    passed_through = [c for c in lines.columns if c != "value"]
    parsed = with_strict_json(lines, py_strip(F.col("value")), "_rec")
    return (
        parsed.select(*passed_through, "value", F.inline(F.array(outcome(F.col("_rec")))))
        .withColumn("line", F.when(F.col("status") == "rejected", F.col("value")))
        .drop("value")
    )


def kept(parsed: DataFrame) -> DataFrame:
    """The conversations: provenance and ``messages``."""
    provenance = [c for c in PROVENANCE if c in parsed.columns]
    return parsed.filter(F.col("status") == "kept").select(*provenance, "messages")


def rejected(parsed: DataFrame) -> DataFrame:
    """The refused lines with reason and text."""
    provenance = [c for c in PROVENANCE if c in parsed.columns]
    return parsed.filter(F.col("status") == "rejected").select(*provenance, "reason", "line")


def rejected_with_line_numbers(lines: DataFrame, parsed: DataFrame) -> DataFrame:
    """The refused lines with file, 1-based line number, reason and text."""
    return line_numbers(lines, rejected(parsed)).select(
        "src_idx", "src_file", "line_no", "reason", "line"
    )


def chat_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The lines of several chat files or folders, ``src_idx`` being the place in the list."""
    if not paths:
        raise IndexError("no chat file given")
    return reduce(DataFrame.unionByName, [read_lines(spark, p, i) for i, p in enumerate(paths)])


def read_chat(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Kept conversations of several files, concatenated in list order, duplicates and all."""
    return kept(parse_chat(chat_lines(spark, paths)))


def ingest_counts(parsed: DataFrame) -> DataFrame:
    """Per source file: kept lines, rejected lines by reason, warnings by reason.

    One row per (file, what) with a count; aggregated before the shuffle, so a file with most of
    the lines costs no more than any other.
    """

    def count_if(condition: Column) -> Column:
        return F.sum(condition.cast("long"))

    wide = parsed.groupBy("src_idx", "src_file").agg(
        count_if(F.col("status") == "kept").alias("kept"),
        *[count_if(F.coalesce(F.col("reason") == r, F.lit(False))).alias(r) for r in (MALFORMED, NON_OBJECT)],
        count_if(F.col("no_messages")).alias(NO_MESSAGES),
        F.sum(F.col("n_invalid").cast("long")).alias(INVALID_MESSAGE),
    )
    return wide.unpivot(
        ["src_idx", "src_file"],
        ["kept", MALFORMED, NON_OBJECT, NO_MESSAGES, INVALID_MESSAGE],
        "what",
        "n",
    )
