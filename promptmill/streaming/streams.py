"""The batch expressions on streams.  Both streams are stateless, in append mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.chat import ChatFormat
from ..functions.text import cut_at_stop, halt_at_stop
from ..operators.context import column_context
from ..operators.predict import PredictorFactory, generate
from ..operators.templates import Template
from ..sinks.writers import write_ingest, write_table
from ..sources.chat import parse_chat, rejected_with_line_numbers
from ..sources.config import InferenceSpec


def answer_requests(
    requests: DataFrame,
    template: Template,
    spec: InferenceSpec,
    factory: PredictorFactory,
    chat_format: ChatFormat | None = None,
    halt: bool = False,
) -> DataFrame:
    """Requests with one text column per template variable, plus prompt and response.

    Values are stripped, as typed-in values are.  ``halt`` first ends the text where a stop
    sequence completes, for predictors that do not stop by themselves.  Works on batch and
    streaming frames.
    """
    context = column_context(requests, template.variables, strip=True)
    prompt = template.prompt(context, chat_format, add_generation_prompt=True)
    answer = F.col("_answer")
    if halt:
        answer = halt_at_stop(answer, spec.stop)
    return (
        requests.withColumn("prompt_text", prompt)
        .withColumn("_answer", generate(F.col("prompt_text"), factory, spec.model, spec.max_tokens))
        .withColumn("response", cut_at_stop(answer, spec.stop))
        .drop("_answer")
    )


def chat_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of chat files as they arrive in a folder, with their provenance."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(path).select(
        F.lit(0).alias("src_idx"),
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.col("value"),
    )


def ingest_stream(lines: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Kept and rejected lines of a stream into ``status=...`` folders, each line parsed once.

    The file sink's log makes every micro-batch count exactly once, after a restart as well.
    """
    return (
        parse_chat(lines)
        .writeStream.format("parquet")
        .partitionBy("status")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def numbered_ingest_stream(lines: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Like :func:`ingest_stream`, and the refused lines with their line numbers.

    A file arrives whole in one micro-batch, so its lines are numbered there, from the counts of its
    input splits, as in a batch job.  Each micro-batch replaces its own folders ``lines/batch=N`` and
    ``rejects/batch=N``: one that runs again after a restart leaves the same rows, once.
    """
    root = path.rstrip("/")

    def sort_out(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        numbered = batch.withColumn("seq", F.monotonically_increasing_id())
        parsed = parse_chat(numbered)
        target = f"{root}/lines/batch={number}"
        write_ingest(parsed, target)
        again = spark.read.schema(parsed.schema).parquet(target)
        write_table(rejected_with_line_numbers(numbered, again), f"{root}/rejects/batch={number}")

    return lines.writeStream.foreachBatch(sort_out).option("checkpointLocation", checkpoint)


def answer_stream(answers: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Write answered requests as they come."""
    return (
        answers.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
