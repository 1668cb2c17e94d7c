"""Partitions that follow the size of the data, and what is numbered or joined in them."""

from __future__ import annotations

from pyspark.sql import functions as F

from promptmill.operators.scoring import join_predictions
from promptmill.operators.sizes import UNBUFFERED_PARTS, parts_for
from promptmill.sources.records import with_record_identity


def test_parts_follow_rows_and_texts(spark):
    rows = spark.range(100).select("id", F.repeat(F.lit("x"), 928).alias("a.b"), F.lit(None).cast("string").alias("c"))
    each = 64 + 8 * 3 + 928
    assert parts_for(rows, part_bytes=10 * each) == 10 and parts_for(rows, rows, part_bytes=10 * each) == 20
    assert parts_for(rows.limit(0)) == parts_for(rows) == 1
    assert parts_for(rows, *[rows] * 2, part_bytes=each) == UNBUFFERED_PARTS


def test_predictions_are_joined_in_parts_that_follow_the_size(spark):
    items = spark.range(700).select("id", F.lit(0).alias("model_idx"), F.col("id").alias("item_id"), F.repeat(F.lit("x"), 100_000).alias("expected"))
    stored = items.select("model_idx", "item_id", F.lit("p").alias("prediction"))
    joined = join_predictions(items.drop("id"), stored)
    assert joined.select(F.spark_partition_id().alias("p")).distinct().count() == 3
    assert joined.filter("prediction = 'p' and length(expected) = 100000").count() == 700


def test_records_of_one_split_are_numbered_by_blocks(spark):
    # Every third line was blank; one file, one split, over two partitions' worth of text.
    rows = spark.range(12_000).filter("id % 3 <> 1").select(
        F.lit(0).alias("src_idx"), F.lit("f/a").alias("src_file"), F.lit(0).cast("long").alias("block_start"),
        (F.lit(5 << 33) + F.col("id")).alias("seq"), "id", F.repeat(F.lit("x"), 10_000).alias("text"),
    )
    found = with_record_identity(rows, ["f"])
    by_part = found.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in by_part) == 8_000 and len(by_part) > 1
    numbers = [(r.id, r.record_no) for r in found.select("id", "record_no").orderBy("id").collect()]
    assert numbers == [(i, at + 1) for at, i in enumerate(i for i in range(12_000) if i % 3 != 1)]
