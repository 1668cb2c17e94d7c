"""Evaluate models: prompts, generation, scores."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from urllib.parse import quote
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import ChatFormat, prompt_text
from ..operators.context import EXPECTED_KEYS, evaluation_context, expected_answer, read_fields, value_text
from ..operators.predict import PredictorFactory, predict_roster
from ..operators.scoring import clean_prediction, exact_match, score_models
from ..operators.templates import Template, load_template, messages_from_text
from ..session import configure, materialize, scratch_path
from ..sinks.counters import observed, write_counts
from ..sinks.writers import read_run_log, write_run_log, write_table
from ..sources.config import EvaluateSpec
from ..sources.records import PROVENANCE, read_records, with_record_identity


def _items(records: DataFrame, template: Template, chat_format: ChatFormat | None, mode: str, on_error: str) -> DataFrame:
    """Provenance, question, prompt_text and expected; with ``quarantine`` a prompt whose rendered text
    has no messages is null, and ``rendered`` is that text."""
    fields = read_fields(records, [*template.variables, "question", *EXPECTED_KEYS])
    frame, rendered = fields.frame, F.lit(None).cast("string")
    if mode == "safe":
        context = evaluation_context(fields, template.variables)
        prompt = template.prompt(context, chat_format, add_generation_prompt=True)
    elif mode == "raw":
        context = evaluation_context(fields, template.variables, python_text=True)
        frame = frame.withColumn("rendered", template.render_raw(context))
        messages = messages_from_text(F.col("rendered"), on_error)
        prompt = prompt_text(messages, chat_format, add_generation_prompt=True)
        rendered = F.col("rendered")
    else:
        raise ValueError(f"mode must be 'safe' or 'raw', not {mode!r}")
    return frame.select(
        *PROVENANCE,
        value_text(fields, "question").alias("question"),
        prompt.alias("prompt_text"),
        expected_answer(fields).alias("expected"),
        rendered.alias("rendered"),
    )


def evaluation_items(
    records: DataFrame, template: Template, chat_format: ChatFormat | None = None, mode: str = "safe"
) -> DataFrame:
    """``(item_id, question, prompt_text, expected)`` for records.

    ``safe`` builds the prompt from the template directly; ``raw`` goes through the rendered
    JSON text, where a value that breaks the JSON ends the job.
    """
    item_id = F.concat_ws(":", *PROVENANCE).alias("item_id")
    return _items(records, template, chat_format, mode, "fail").select(item_id, "question", "prompt_text", "expected")


def run_evaluate(
    spark: SparkSession,
    spec: EvaluateSpec,
    factory: PredictorFactory,
    verdicts: DataFrame | None = None,
    chat_format: ChatFormat | None = None,
    stop: Sequence[str] = (),
    mode: str = "safe",
    log_path: str | None = None,
    run_id: str | None = None,
    layout: str = "auto",
    on_error: str = "fail",
) -> DataFrame:
    """Scores per model.  The run log is written first and scored from disk.

    Items are rendered once, written, and read for every model; an item is called by its source, its
    path below it and its number in the file.  Generation is the costly step: it runs once, and
    everything after it reads the log.  With ``on_error="quarantine"`` items whose raw text has no
    messages are left out of the scores and written to ``<log_path>.rejects``.  The numbers of items,
    rejects and answers are counted as they are written, into ``<log_path>.counts``.
    """
    configure(spark)
    log_path = log_path or scratch_path(spark, "run-log")
    # Jobs that start in the same second are different runs.
    run_id = run_id or f"{datetime.now(timezone.utc):%Y%m%d_%H%M%S}_{uuid4().hex[:8]}"
    if not spec.models:
        return score_models(spark.createDataFrame([], "model_idx int, prediction string, exact int"), [])

    template = load_template(spark, spec.prompt_template)
    found, seen = observed(
        _items(read_records(spark, spec.data_path, layout), template, chat_format, mode, on_error),
        items=F.lit(True),
        rejects=F.col("prompt_text").isNull() & F.col("rendered").isNotNull(),
    )
    rows = with_record_identity(materialize(found, "items"), [spec.data_path])
    item_id = F.concat_ws(":", "src_idx", "src_path", "record_no").alias("item_id")
    rejected = F.col("prompt_text").isNull() & F.col("rendered").isNotNull()
    if on_error == "quarantine":
        write_table(rows.filter(rejected).select(item_id, "rendered"), f"{log_path.rstrip('/')}.rejects/run_id={quote(run_id, safe='')}")
        rows = rows.filter(~rejected)
    items = rows.select(item_id, "question", "prompt_text", "expected")
    answered = (
        predict_roster(items, "prompt_text", spec.models, factory, spec.max_tokens)
        .withColumn("prediction", clean_prediction(F.col("prediction"), stop))
        .withColumn("exact", exact_match(F.col("prediction"), F.col("expected")))
    )
    answered, answers = observed(answered, answers=F.lit(True), exact=F.col("exact") == 1)
    write_run_log(answered, run_id, log_path)
    write_counts(spark, {**seen(), **answers()}, f"{log_path.rstrip('/')}.counts/run_id={quote(run_id, safe='')}")
    return score_models(read_run_log(spark, log_path, run_id), spec.models, verdicts)
