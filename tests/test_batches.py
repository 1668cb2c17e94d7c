"""Shards of bounded tokens: the order of the layout, whole steps, even weights."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from promptmill.operators import batches
from promptmill.operators.batches import batch_layout, sharded_batches


@pytest.mark.parametrize("rows, shard_tokens, digits", [(500, 300, 4), (500, 300, 1), (500, 10**9, 1), (37, 1, 4), (1, 5, 4), (0, 5, 4)])
def test_shards_follow_the_layout(spark, rows, shard_tokens, digits):
    tokens = spark.range(rows).selectExpr("id as k", "cast(1 + id % 9 as int) as n", "sequence(1, 1 + id % 9) as ids")
    layout = batch_layout(tokens, ["k"], "n", 4, 3, 2, 5)
    expected = {(r.epoch, r.k): (r.row_index, r.batch_id, r.batch_length) for r in layout.collect()}
    found = sharded_batches(tokens, ["k"], F.col("n"), 4, 3, 2, 5, 2, shard_tokens, digits)
    found = found.withColumn("part", F.spark_partition_id()).collect()
    assert {(r.epoch, r.k): (r.row_index, r.batch_id, r.batch_length) for r in found} == expected
    assert len(found) == 2 * rows
    shards, part = {}, {}
    for r in found:
        assert r.step_id == r.row_index // 24 and r.device == r.batch_id % 2
        shards.setdefault((r.epoch, r.shard), []).append(r)
    for inside in shards.values():
        assert len({r.part for r in inside}) == 1
        assert [r.row_index for r in inside] == list(range(inside[0].row_index, inside[0].row_index + len(inside)))
        assert inside[0].row_index % 24 == 0
        # About the weight asked for; a step of 24 rows has about 120 tokens.
        assert sum(r.n for r in inside) <= max(1.7 * shard_tokens, 24 * 9)
    if shard_tokens == 300 and rows == 500:
        assert len(shards) >= 14


def test_number_of_shards_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(batches, "MOST_SHARDS", 5)
    tokens = spark.range(600).selectExpr("id as k", "10 as n")
    found = sharded_batches(tokens, ["k"], F.col("n"), 2, shard_tokens=1)
    assert 4 <= found.select("epoch", "shard").distinct().count() <= 6


def test_wide_rows_are_shuffled_once(spark):
    tokens = spark.range(600).selectExpr("id as k", "10 as n", "array(id) as ids")
    found = sharded_batches(tokens, ["k"], F.col("n"), 2, shard_tokens=100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(epoch") == 1
