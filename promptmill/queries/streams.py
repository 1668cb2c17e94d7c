"""The streaming jobs over a given table, run to the end of what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.templates import Template
from ..session import scratch_path
from ..sources.chat import chat_lines, parse_chat, rejected_with_line_numbers
from ..sources.config import InferenceSpec
from ..streaming.streams import answer_requests, answer_stream, chat_file_stream, ingest_stream, numbered_ingest_stream
from .chat import mixed_lines
from .registry import query, table
from .render import INFERENCE_TEMPLATE, SYSTEM
from .scoring import MODELS, stub_factory


@query(
    f"""SELECT conv_id, turn, prompt_text, 'base/alpha:' || length(prompt_text) || ':' || (length(prompt_text) - length(replace(prompt_text, ' ', ''))) || ':50' AS response
        FROM (SELECT conv_id, turn, '{SYSTEM}' || chr(10) || '<tables>' || role || '</tables>Wanted: ' || text || ' Statement =' AS prompt_text FROM conversations)"""
)
def request_stream(spark, folder):
    """Requests arriving as files, answered and written as they come."""
    source = scratch_path(spark, "requests")
    table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.concat(F.lit(" \t"), F.col("text"), F.lit("　\n")).alias("question"),
        F.col("role").alias("schema"),
    ).write.parquet(source)
    requests = spark.readStream.schema("conv_id long, turn long, question string, schema string").parquet(source)
    spec = InferenceSpec(MODELS[0], "-", ("```", ";\n"))
    out = scratch_path(spark, "answers")
    answers = answer_requests(requests, Template(INFERENCE_TEMPLATE), spec, stub_factory)
    answer_stream(answers, out, scratch_path(spark, "answers-log")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).select("conv_id", "turn", "prompt_text", "response")


@query(
    """SELECT status, coalesce(reason, '') AS reason, count(*) AS n, CAST(sum(chars) AS BIGINT) AS n_chars FROM (
        SELECT CASE WHEN turn IN (0, 1, 2, 6) THEN 'kept' ELSE 'rejected' END AS status,
            CASE turn WHEN 3 THEN 'malformed' WHEN 4 THEN 'non_object' WHEN 7 THEN 'malformed' END AS reason,
            CASE WHEN turn IN (0, 2) THEN length(text) WHEN turn = 1 THEN length(text) + 2 ELSE 0 END AS chars
        FROM conversations WHERE turn <> 5)
    GROUP BY ALL"""
)
def chat_stream(spark, folder):
    """Chat files as they arrive, sorted into kept and rejected lines."""
    source, out = scratch_path(spark, "arriving"), scratch_path(spark, "sorted")
    # A refused text with raw line breaks would be several lines of a file.
    mixed_lines(spark, folder).select(F.regexp_replace("value", "\n", " ")).write.text(source)
    ingest_stream(chat_file_stream(spark, source), out, scratch_path(spark, "sorted-log")).trigger(
        availableNow=True
    ).start().awaitTermination()
    chars = F.aggregate("messages", F.lit(0), lambda n, m: n + F.coalesce(F.length(m["content"]), F.lit(0)))
    return (
        spark.read.parquet(out)
        .groupBy("status", F.coalesce("reason", F.lit("")).alias("reason"))
        .agg(F.count("*").alias("n"), F.sum(F.coalesce(chars, F.lit(0))).alias("n_chars"))
    )


@query(
    """SELECT CASE WHEN turn = 4 THEN 'non_object' ELSE 'malformed' END AS reason, count(*) AS n, count(*) AS n_numbered
        FROM conversations WHERE turn IN (3, 4, 7) GROUP BY ALL"""
)
def stream_line_numbers(spark, folder):
    """Refused lines of arriving files, and how many of them a batch job gives with the same file and number."""
    source, out = scratch_path(spark, "arriving"), scratch_path(spark, "numbered")
    mixed_lines(spark, folder).select(F.regexp_replace("value", "\n", " ")).write.text(source)
    stream = numbered_ingest_stream(chat_file_stream(spark, source), out, scratch_path(spark, "numbered-log"))
    stream.trigger(availableNow=True).start().awaitTermination()
    lines = chat_lines(spark, [source])
    batch = rejected_with_line_numbers(lines, parse_chat(lines)).withColumn("numbered", F.lit(1))
    found = spark.read.parquet(f"{out}/rejects").join(batch, ["src_file", "line_no", "reason", "line"], "left")
    return found.groupBy("reason").agg(F.count("*").alias("n"), F.count("numbered").alias("n_numbered"))
