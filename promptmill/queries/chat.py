"""Chat lines on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import ChatFormat, prompt_text
from ..operators.conversations import assemble_conversations
from ..session import scratch_path
from ..sinks.writers import write_ingest
from ..sources.chat import (
    chat_lines,
    ingest_counts,
    kept,
    parse_chat,
    rejected_with_line_numbers,
)
from ..sources.records import concat_sources, lines_with_provenance, read_lines
from .registry import message, query, table

GREETING = "You answer briefly."
FORMAT = ChatFormat("<s>", "<|", "|>", "<|end|>", "<|assistant|>")


def conversation_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Each turn as a chat line of two messages: a fixed system message and the turn."""
    messages = F.array(message("system", GREETING), message(F.col("role"), F.col("text")))
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", F.to_json(F.struct(messages.alias("messages"))).alias("value")
    )


@query(
    f"""SELECT conv_id, turn, '{GREETING}' || chr(10) || text AS joined,
        '<s><|system|>{GREETING}<|end|><|' || role || '|>' || text || '<|end|><|assistant|>' AS formatted FROM conversations"""
)
def chat_prompt(spark, folder):
    """Prompt text of chat lines, plain and in a chat format."""
    parsed = parse_chat(conversation_lines(spark, folder))
    return parsed.select(
        "conv_id",
        "turn",
        prompt_text(F.col("messages")).alias("joined"),
        prompt_text(F.col("messages"), FORMAT, add_generation_prompt=True).alias("formatted"),
    )


# What becomes of turn n of a conversation: the line as JSON, and what the reader makes of it.
def mixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as lines of every kind, by their place in the conversation."""
    one = message(F.col("role"), F.col("text"))
    quoted = F.to_json(F.array("text"))
    value = (
        F.when(F.col("turn") == 0, F.to_json(F.struct(F.array(one).alias("messages"), F.lit(1).alias("extra"))))
        .when(F.col("turn") == 1, F.to_json(F.array(one, message("assistant", "ok"))))
        .when(F.col("turn") == 2, F.concat(F.lit('{"messages": [5, {"content": '), F.btrim(quoted, F.lit("[]")), F.lit('}, "x", {"role": "user", "content": null}]}')))
        .when(F.col("turn") == 3, F.concat(F.to_json(F.struct(F.array(one).alias("messages"))), F.lit(" trailing")))
        .when(F.col("turn") == 4, F.btrim(quoted, F.lit("[]")))
        .when(F.col("turn") == 5, F.lit(" \t "))
        .when(F.col("turn") == 6, F.lit('{"messages": "none"}'))
        .otherwise(F.concat(F.lit("{bad "), F.col("text")))
    )
    return table(spark, folder, "conversations").select("conv_id", "turn", value.alias("value"))


_KIND = "CASE WHEN turn IN (0, 1, 2, 6) THEN 'kept' ELSE 'rejected' END"


@query(
    f"""SELECT conv_id, turn, {_KIND} AS status,
        CASE turn WHEN 3 THEN 'malformed' WHEN 4 THEN 'non_object' WHEN 7 THEN 'malformed' END AS reason,
        CASE turn WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 6 THEN 0 END AS n_messages,
        CASE turn WHEN 0 THEN role WHEN 1 THEN role WHEN 2 THEN '' END AS first_role,
        CASE WHEN turn <= 2 THEN text END AS first_content,
        CASE turn WHEN 1 THEN 'ok' END AS second_content,
        CASE WHEN turn = 2 THEN 2 ELSE 0 END AS n_invalid,
        CASE WHEN turn = 6 THEN 1 ELSE 0 END AS no_messages
        FROM conversations WHERE turn <> 5"""
)
def ingest_quarantine(spark, folder):
    """Row by row: kept or rejected, why, and the normalised messages."""
    return parse_chat(mixed_lines(spark, folder)).select(
        "conv_id",
        "turn",
        "status",
        "reason",
        F.when(F.col("status") == "kept", F.size("messages")).alias("n_messages"),
        F.get("messages", F.lit(0))["role"].alias("first_role"),
        F.get("messages", F.lit(0))["content"].alias("first_content"),
        F.get("messages", F.lit(1))["content"].alias("second_content"),
        "n_invalid",
        F.col("no_messages").cast("int").alias("no_messages"),
    )


@query(
    """SELECT what, n FROM (
        SELECT 'kept' AS what, count(*) FILTER (turn IN (0, 1, 2, 6)) AS n FROM conversations
        UNION ALL SELECT 'malformed', count(*) FILTER (turn IN (3, 7)) FROM conversations
        UNION ALL SELECT 'non_object', count(*) FILTER (turn = 4) FROM conversations
        UNION ALL SELECT 'no_messages', count(*) FILTER (turn = 6) FROM conversations
        UNION ALL SELECT 'invalid_message', 2 * count(*) FILTER (turn = 2) FROM conversations)"""
)
def ingest_counters(spark, folder):
    """Counts by outcome, read from the kept and rejected lines as they were written."""
    path = scratch_path(spark, "ingest")
    lines = lines_with_provenance(mixed_lines(spark, folder), "value")
    parsed = parse_chat(lines)
    write_ingest(parsed, path)
    return ingest_counts(spark.read.schema(parsed.schema).parquet(path)).select("what", "n")


@query(
    """SELECT conv_id, turn, 0 AS line_difference,
        CASE WHEN turn = 4 THEN 'non_object' ELSE 'malformed' END AS reason
        FROM conversations WHERE turn IN (3, 4, 7)"""
)
def reject_lines(spark, folder):
    """Line numbers of refused lines in written files.

    Each refused line also carries the line number it was written at, so the difference is 0.
    """
    # A part file holds one partition, whose rows have consecutive ids in the lower 33 bits.
    mixed = mixed_lines(spark, folder).withColumn("id", F.monotonically_increasing_id())
    place = F.col("id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    tag = F.concat_ws(",", "conv_id", "turn", place)
    tagged = mixed.select(
        F.when(F.col("turn").isin(3, 7), F.concat(F.lit("{bad "), tag))
        .when(F.col("turn") == 4, F.concat(F.lit('"'), tag, F.lit('"')))
        .otherwise(F.col("value"))
        .alias("value")
    )
    path = scratch_path(spark, "rejects")
    tagged.write.text(path)
    lines = read_lines(spark, path)
    found = rejected_with_line_numbers(lines, parse_chat(lines))
    parts = F.split(F.regexp_extract("line", "([0-9,]+)", 1), ",")
    return found.select(
        parts[0].cast("bigint").alias("conv_id"),
        parts[1].cast("bigint").alias("turn"),
        (F.col("line_no") - parts[2].cast("bigint")).cast("int").alias("line_difference"),
        "reason",
    )


@query(
    """SELECT 0 AS src_idx, 'user' AS role, text AS content FROM benchmark
    UNION ALL SELECT 1, lang, text FROM documents
    UNION ALL SELECT 2, role, text FROM conversations
    UNION ALL SELECT 3, 'user', text FROM benchmark"""
)
def union_sources(spark, folder):
    """Several sources as one, in list order, the first one twice."""

    def source(name, role):
        rows = table(spark, folder, name).select(
            F.to_json(F.array(message(role, F.col("text")))).alias("value")
        )
        return kept(parse_chat(lines_with_provenance(rows, "value", src_file=name)))

    benchmark = source("benchmark", "user")
    sources = [benchmark, source("documents", F.col("lang")), source("conversations", F.col("role")), benchmark]
    return concat_sources(sources).select(
        "src_idx", F.col("messages")[0]["role"].alias("role"), F.col("messages")[0]["content"].alias("content")
    )


@query("SELECT conv_id, turn, role, text AS content FROM conversations")
def read_chat_files(spark, folder):
    """Turns written as chat files to the shared folder and read back."""
    tagged = F.array(
        message(F.col("role"), F.col("text")),
        message("key", F.concat_ws(",", "conv_id", "turn")),
    )
    path = scratch_path(spark, "chat")
    table(spark, folder, "conversations").select(F.to_json(F.struct(tagged.alias("messages")))).write.text(path)
    rows = kept(parse_chat(chat_lines(spark, [path])))
    key = F.split(F.col("messages")[1]["content"], ",")
    return rows.select(
        key[0].cast("bigint").alias("conv_id"),
        key[1].cast("bigint").alias("turn"),
        F.col("messages")[0]["role"].alias("role"),
        F.col("messages")[0]["content"].alias("content"),
    )


@query(
    """SELECT 'documents' AS kind, source AS name, count(*) AS n FROM documents GROUP BY source
    UNION ALL SELECT 'conversations', role, count(*) FROM conversations GROUP BY role"""
)
def dataset_counts(spark, folder):
    docs = table(spark, folder, "documents").groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n"))
    turns = table(spark, folder, "conversations").groupBy(F.col("role").alias("name")).agg(F.count("*").alias("n"))
    return docs.select(F.lit("documents").alias("kind"), "name", "n").unionByName(
        turns.select(F.lit("conversations").alias("kind"), "name", "n")
    )


@query(
    """SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN 'malformed' ELSE 'kept' END AS outcome,
        CASE WHEN doc_id % 4 <> 3 THEN length(text) END AS n_chars FROM documents"""
)
def long_lines(spark, folder):
    """Lines beyond the limits of the JVM's parser: long numbers, deep lists, and refused ones among them."""
    case = F.col("doc_id") % 4
    more = F.when(case == 0, F.repeat(F.lit("7"), 1500)).when(
        case == 1, F.concat(F.repeat(F.lit("["), 1100), F.repeat(F.lit("]"), 1100))
    )
    more = more.when(case == 2, F.lit("0")).otherwise(F.concat(F.repeat(F.lit("["), 1100), F.repeat(F.lit("]"), 1099)))
    chat = F.to_json(F.struct(F.array(message("user", F.col("text"))).alias("messages")))
    value = F.concat(F.lit('{"more":'), more, F.lit(","), F.substring(chat, 2, F.length(chat)))
    lines = table(spark, folder, "documents").select("doc_id", value.alias("value"))
    rows = parse_chat(lines)
    content = F.get("messages", F.lit(0))["content"]
    return rows.select("doc_id", F.coalesce("reason", "status").alias("outcome"), F.length(content).cast("long").alias("n_chars"))


MOST_TURNS = 3


@query(
    f"""SELECT conv_id, part, CAST(count(*) AS INTEGER) AS n_messages, string_agg(role, ',' ORDER BY place) AS roles,
        md5(string_agg('<|' || role || '|>' || text, '' ORDER BY place)) AS content_md5
        FROM (SELECT *, (place - 1) // {MOST_TURNS} AS part FROM (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place FROM conversations))
        GROUP BY conv_id, part"""
)
def assemble_conversation(spark, folder):
    """Turns spread over rows, gathered into conversations of parts of bounded length."""
    rows = assemble_conversations(table(spark, folder, "conversations"), most_turns=MOST_TURNS)
    said = F.transform("messages", lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>"), m["content"]))
    return rows.select(
        "conv_id",
        "part",
        F.size("messages").alias("n_messages"),
        F.array_join(F.col("messages")["role"], ",").alias("roles"),
        F.md5(F.array_join(said, "").cast("binary")).alias("content_md5"),
    )
