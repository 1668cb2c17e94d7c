"""Tokens, padding and batches on whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.batches import batch_layout, sharded_batches, with_layout
from ..operators.rows import map_rows
from ..operators.tokens import collate, encoder_ids, hashed_ids, tokenize, word_tokens
from ..plans.train_data import run_train_data
from ..session import materialize, scratch_path
from ..sources.config import TrainingSpec
from .registry import message, query, table

VOCABULARY, RESERVED, PAD = 32_000, 4, 0
MAX_LENGTH = 64

_WORDS = r"len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_ \t\r\n]'))"


@query(f"SELECT doc_id, {_WORDS} AS n_tokens, length(text) AS n_chars FROM documents")
def tokenize_len(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id", F.size(word_tokens(F.col("text"))).alias("n_tokens"), F.length("text").alias("n_chars")
    )


@query(
    f"""SELECT conv_id, turn, least(n, {MAX_LENGTH}) AS n_tokens, {MAX_LENGTH} AS n_ids, {MAX_LENGTH} AS n_labels,
        least(n, {MAX_LENGTH}) AS mask_sum, {MAX_LENGTH} - least(n, {MAX_LENGTH}) AS n_pads
        FROM (SELECT conv_id, turn, {_WORDS} AS n FROM conversations)"""
)
def pad_truncate(spark, folder):
    """Ids cut at and padded to the maximum, labels a copy."""
    turns = table(spark, folder, "conversations")
    ids = hashed_ids(F.col("text"), VOCABULARY, RESERVED)
    rows = tokenize(turns, ids, ["conv_id", "turn"], MAX_LENGTH, PAD)
    return rows.select(
        "conv_id",
        "turn",
        "n_tokens",
        F.size("input_ids").alias("n_ids"),
        F.size("labels").alias("n_labels"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
        F.size(F.filter("labels", lambda x: x == PAD)).alias("n_pads"),
    )


def _word_lengths():
    """A stand-in for a user's tokenizer: the length of each space-separated piece."""
    return lambda texts: [[len(piece) for piece in t.split(" ")] for t in texts]


@query(
    """SELECT doc_id, len(string_split(text, ' ')) AS n_ids, length(replace(text, ' ', '')) AS id_sum FROM documents"""
)
def encode_with_user_tokenizer(spark, folder):
    docs = table(spark, folder, "documents")
    rows = tokenize(docs, encoder_ids(F.col("text"), _word_lengths), ["doc_id"], add_labels=False)
    return rows.select(
        "doc_id",
        F.col("n_tokens").alias("n_ids"),
        F.aggregate("input_ids", F.lit(0), lambda a, x: a + x).alias("id_sum"),
    )


BATCH, ACCUMULATE, EPOCHS, SEED = 8, 4, 2, 7

_LAYOUT = f"""WITH counted AS (
    SELECT conv_id, turn, {_WORDS} AS n_tokens FROM conversations
), placed AS (
    SELECT conv_id, turn, n_tokens, epoch, row_number() OVER (
        PARTITION BY epoch ORDER BY md5('{SEED}|' || epoch || '|' || conv_id || '|' || turn)) - 1 AS row_index
    FROM counted, (VALUES {", ".join(f"({e})" for e in range(EPOCHS))}) AS e(epoch)
), laid AS (
    SELECT *, row_index // {BATCH} AS batch_id, row_index // {BATCH * ACCUMULATE} AS step_id,
        max(n_tokens) OVER (PARTITION BY epoch, row_index // {BATCH}) AS batch_length FROM placed)"""


@query(f"{_LAYOUT} SELECT conv_id, turn, epoch, row_index, batch_id, step_id, batch_length FROM laid")
def batch_order(spark, folder):
    """Seeded order, batch and step of every turn in every epoch."""
    rows = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.size(word_tokens(F.col("text"))).alias("n_tokens")
    )
    return batch_layout(rows, ["conv_id", "turn"], "n_tokens", BATCH, ACCUMULATE, EPOCHS, SEED)


@query(
    f"""{_LAYOUT} SELECT conv_id, turn, epoch, batch_id, batch_length AS n_ids, batch_length AS n_mask,
        n_tokens AS mask_sum, batch_length - n_tokens AS n_ignored FROM laid"""
)
def batch_pad(spark, folder):
    """Rows padded to the longest of their batch, pad positions ignored in the labels."""
    turns = table(spark, folder, "conversations")
    key = ["conv_id", "turn"]
    ids = hashed_ids(F.col("text"), VOCABULARY, RESERVED)
    tokens = materialize(tokenize(turns, ids, key, add_labels=False), "tokens")
    layout = batch_layout(tokens, key, "n_tokens", BATCH, ACCUMULATE, EPOCHS, SEED)
    rows = collate(with_layout(tokens, layout, key), PAD)
    return rows.select(
        *key,
        "epoch",
        "batch_id",
        F.size("input_ids").alias("n_ids"),
        F.size("attention_mask").alias("n_mask"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("mask_sum"),
        F.size(F.filter("labels", lambda x: x == -100)).alias("n_ignored"),
    )


@query(
    f"""SELECT e.epoch, count(*) AS n_rows, CAST(ceil(count(*) / {BATCH}) AS BIGINT) AS n_batches,
        CAST(ceil(count(*) / {BATCH * ACCUMULATE}) AS BIGINT) AS n_steps, CAST(sum({_WORDS}) AS BIGINT) AS n_tokens
        FROM conversations, (VALUES {", ".join(f"({e})" for e in range(EPOCHS))}) AS e(epoch) GROUP BY e.epoch"""
)
def training_job(spark, folder):
    """Chat files to padded batches on disk, counted from there."""
    source, out = scratch_path(spark, "chat"), scratch_path(spark, "training")
    lines = F.to_json(F.struct(F.array(message(F.col("role"), F.col("text"))).alias("messages")))
    table(spark, folder, "conversations").select(lines).write.text(source)
    spec = TrainingSpec(
        (source,), out, num_epochs=EPOCHS, batch_size=BATCH, gradient_accumulation_steps=ACCUMULATE, seed=SEED
    )
    batches = run_train_data(spark, spec, lambda t: hashed_ids(t, VOCABULARY, RESERVED), PAD)
    return batches.groupBy("epoch").agg(
        F.count("*").alias("n_rows"),
        (F.max("batch_id") + 1).alias("n_batches"),
        (F.max("step_id") + 1).alias("n_steps"),
        F.sum(F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)).alias("n_tokens"),
    )


DEVICES, SHARD = 2, 512
_STEP = BATCH * ACCUMULATE * DEVICES


@query(
    f"""{_LAYOUT} SELECT epoch, batch_id, batch_id % {DEVICES} AS device, row_index // {_STEP} AS step_id, count(*) AS n_rows,
        CAST(sum(batch_length) AS BIGINT) AS n_ids, CAST(sum(n_tokens) AS BIGINT) AS mask_sum,
        CAST(sum(batch_length - n_tokens) AS BIGINT) AS n_ignored,
        1 AS n_shards FROM laid GROUP BY ALL"""
)
def sharded_training_batches(spark, folder):
    """Batches in shards of bounded tokens on two devices: sums of ids, masks and labels of each."""
    turns = table(spark, folder, "conversations")
    key = ["conv_id", "turn"]
    ids = hashed_ids(F.col("text"), VOCABULARY, RESERVED)
    tokens = materialize(tokenize(turns, ids, key, add_labels=False), "tokens")
    rows = sharded_batches(tokens, key, F.col("n_tokens"), BATCH, ACCUMULATE, EPOCHS, SEED, DEVICES, SHARD)
    rows = collate(rows, PAD)
    return rows.groupBy("epoch", "batch_id", F.col("device").cast("long").alias("device"), "step_id").agg(
        F.count("*").alias("n_rows"),
        F.sum(F.size("input_ids")).alias("n_ids"),
        F.sum(F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)).alias("mask_sum"),
        F.sum(F.size(F.filter("labels", lambda x: x == -100))).alias("n_ignored"),
        # A batch never crosses a shard.
        F.count_distinct("shard").cast("int").alias("n_shards"),
    )


def _sentences():
    """A stand-in for a user's function: a row for each line of a text, with its number and length."""

    def cut(rows):
        found = [(i, k, len(line)) for i, text in zip(rows["doc_id"], rows["text"]) for k, line in enumerate(text.split("\n"))]
        return dict(zip(("doc_id", "line_no", "n_chars"), map(list, zip(*found)))) if found else {}

    return cut


@query(
    """SELECT doc_id, i - 1 AS line_no, length(lines[i]) AS n_chars
        FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
            FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))"""
)
def rows_by_function(spark, folder):
    """A user's function that makes several rows of one."""
    return map_rows(table(spark, folder, "documents"), _sentences, "doc_id long, line_no long, n_chars long", ["doc_id", "text"])
