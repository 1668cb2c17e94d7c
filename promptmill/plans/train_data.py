"""Chat files to training-ready batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import ChatFormat, prompt_text
from ..operators.batches import SHARD_TOKENS, sharded_batches
from ..operators.tokens import collate, tokenize
from ..session import configure
from ..sinks.writers import read_back, write_config, write_ingest, write_prompt_log, write_table
from ..sources.chat import chat_lines, ingest_counts, kept, parse_chat, rejected_with_line_numbers
from ..sources.config import TrainingSpec
from ..sources.records import IDENTITY, PROVENANCE, with_identity


def prompts(conversations: DataFrame, chat_format: ChatFormat | None = None, null_content: str = "fail") -> DataFrame:
    text = prompt_text(F.col("messages"), chat_format, null_content=null_content)
    keys = [c for c in (*PROVENANCE, "src_path", "line_no") if c in conversations.columns]
    return conversations.select(*keys, text.alias("prompt_text"))


def run_train_data(
    spark: SparkSession,
    spec: TrainingSpec,
    to_ids: Callable[[Column], Column],
    pad_id: int,
    max_length: int | None = None,
    chat_format: ChatFormat | None = None,
    null_content: str = "fail",
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """Build the training data below ``spec.output_dir`` and return the batches.

    ``to_ids`` is a function from a text column to a column of token ids.  Written are
    ``ingest`` (kept and rejected lines), ``counts``, ``rejects`` (with line numbers), ``prompts``,
    ``tokens``, ``batches`` and ``config``.  Each table is computed once, from the one before it.
    Batches lie in shards of about ``shard_tokens`` tokens, whole steps each, about a file a shard.
    The seeded order depends on source, path below the source and line number only, not on how the
    files are split or where they lie.
    """
    configure(spark)
    out = spec.output_dir.rstrip("/")
    if spec.pad_to_max_length and max_length is None:
        raise ValueError("padding to the maximum needs max_length")

    parsed_path = f"{out}/ingest"
    lines = chat_lines(spark, spec.datasets)
    parsed = parse_chat(lines)
    write_ingest(parsed, parsed_path)
    parsed = read_back(parsed, parsed_path)
    write_table(ingest_counts(parsed), f"{out}/counts")
    write_table(rejected_with_line_numbers(lines, parsed), f"{out}/rejects")

    prompt_rows = prompts(with_identity(lines, kept(parsed), spec.datasets), chat_format, null_content)
    write_prompt_log(prompt_rows, "prompt_text", f"{out}/prompts")
    prompt_rows = read_back(prompt_rows, f"{out}/prompts")

    tokens = tokenize(
        prompt_rows,
        to_ids(F.col("prompt_text")),
        keep=IDENTITY,
        max_length=max_length,
        pad_id=pad_id if spec.pad_to_max_length else None,
        add_labels=False,
    )
    write_table(tokens, f"{out}/tokens")
    tokens = read_back(tokens, f"{out}/tokens")

    length = F.lit(max_length) if spec.pad_to_max_length else F.col("n_tokens")
    batches = sharded_batches(
        tokens,
        IDENTITY,
        length,
        spec.batch_size,
        spec.gradient_accumulation_steps,
        spec.num_epochs,
        spec.seed,
        spec.devices,
        shard_tokens,
    )
    batches = collate(batches, pad_id)
    write_table(batches, f"{out}/batches")
    write_config(spark, spec.kept_settings or vars(spec), f"{out}/config")
    return read_back(batches, f"{out}/batches")
