"""Conversations from rows of turns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ordered import in_order

#: Turns of one row of the result at most.
MOST_TURNS = 1000


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def assemble_conversations(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    most_turns: int = MOST_TURNS,
) -> DataFrame:
    """``(conversation, part, messages)``: the turns of each conversation in order, as messages.

    A conversation of up to ``most_turns`` turns is one row with ``part`` 0; a longer one goes on in
    further parts of as many turns, cut by place, so no row and no group grows with a conversation.

    Turns are dealt by ranges of (conversation, turn), which cuts a hot conversation over as many
    tasks as it fills, and numbered where they lie.  Only conversations longer than a part need
    their places: the turns of each in the tasks before are summed up from one small row per
    conversation and task.

    Turns of null number come first; equal numbers are in order of role and content; a null
    conversation is one like any other.
    """
    rows = turns.select(
        F.col(conversation).alias("_conv"), F.col(turn).alias("_turn"), F.col(role).cast("string").alias("role"),
        F.col(content).cast("string").alias("content"),
    )
    short = [F.col("_conv"), F.col("_turn"), F.col("role"), F.substring("content", 1, 64)]
    placed = in_order(rows, short, [*short[:3], F.col("content")])
    # The number of the task and of the row in it: in order over all tasks.
    placed = materialize(placed.select("_conv", "role", "content", F.monotonically_increasing_id().alias("_seq")), "turns")
    placed = placed.withColumn("_task", F.shiftright("_seq", 33))

    per_task = placed.groupBy("_conv", "_task").agg(F.min("_seq").alias("_first"), F.count("*").alias("_n"))
    # A conversation has at most a row a task here.
    within = Window.partitionBy("_conv")
    before = F.coalesce(F.sum("_n").over(within.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    per_task = per_task.select("*", F.sum("_n").over(within).alias("_all"), before.alias("_before"))
    long = per_task.filter(F.col("_all") > most_turns).select(
        F.col("_conv").alias("_c"), F.col("_task").alias("_t"), (F.col("_before") - F.col("_first")).alias("_shift")
    )
    joined = placed.join(long, _same("_conv", "_c") & (F.col("_task") == F.col("_t")), "left")
    part = F.coalesce(F.floor((F.col("_seq") + F.col("_shift")) / most_turns), F.lit(0))
    groups = joined.select("_conv", part.alias("part"), "_seq", F.struct("role", "content").alias("m")).groupBy("_conv", "part")
    # At most ``most_turns`` turns.
    messages = F.transform(F.array_sort(F.collect_list(F.struct("_seq", "m"))), lambda x: x["m"])
    return groups.agg(messages.alias("messages")).withColumnRenamed("_conv", conversation)
