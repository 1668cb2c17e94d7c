"""Conversations from turns, numbered streams, a user's row function."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from promptmill.operators.conversations import assemble_conversations
from promptmill.operators.rows import map_rows
from promptmill.sources.chat import chat_lines, parse_chat, rejected_with_line_numbers
from promptmill.streaming.streams import chat_file_stream, numbered_ingest_stream


@pytest.fixture
def many_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def _turns():
    rows = [(c, t, ("user", "assistant")[t % 2], f"{c} {t}") for c in range(40) for t in range(c % 6)]
    # A conversation with more than a third of all rows, equal numbers, nulls, repeated rows.
    rows += [(99, t, "user", str(t)) for t in range(300)]
    rows += [(7, None, "system", "first"), (7, 2, "b", "y"), (7, 2, "b", "x"), (None, 1, "user", None), (None, 0, None, "z")]
    return rows + [(12, 1, "user", "same")] * 3


@pytest.mark.parametrize("most", [1000, 7])
def test_turns_become_conversations(spark, many_partitions, most):
    rows = _turns()
    turns = spark.createDataFrame(rows, "c long, t long, r string, x string")
    found = assemble_conversations(turns, "c", "t", "r", "x", most)
    expected = {}
    for c, t, r, x in sorted(rows, key=lambda v: (v[1] is not None, v[1] or 0, v[2] or "", v[3] or "")):
        expected.setdefault(c, []).append((r, x))
    got = {}
    for row in found.orderBy("part").collect():
        assert len(row.messages) <= most
        before = got.setdefault(row.c, [])
        assert len(before) == row.part * most
        before += [tuple(m) for m in row.messages]
    assert got == expected


def test_a_hot_conversation_is_in_many_tasks(spark, many_partitions):
    turns = spark.createDataFrame(_turns(), "c long, t long, r string, x string")
    found = assemble_conversations(turns, "c", "t", "r", "x", 7).filter("c = 99")
    assert found.select(F.spark_partition_id().alias("p")).distinct().count() > 10


def test_no_turns(spark):
    assert assemble_conversations(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def test_stream_numbers_equal_batch_numbers(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    os.mkdir(source)

    def arrive(name, lines):
        (tmp_path / "in" / name).write_text("\n".join(lines) + "\n")

    def drain():
        stream = numbered_ingest_stream(chat_file_stream(spark, source), out, log)
        stream.trigger(availableNow=True).start().awaitTermination()

    good = json.dumps([{"role": "user", "content": "x" * 50}])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    try:
        arrive("a.jsonl", ["", good, "{bad", *[good] * 20, "5", good])
        drain()
        arrive("b.jsonl", ["{bad"])
        arrive("c.jsonl", [*[good] * 9, '"text"'])
        # A stream started anew goes on behind what is done.
        drain()
        lines = chat_lines(spark, [source])
        batch = sorted((os.path.basename(r.src_file), r.line_no, r.reason) for r in rejected_with_line_numbers(lines, parse_chat(lines)).collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert batch == [("a.jsonl", 3, "malformed"), ("a.jsonl", 24, "non_object"), ("b.jsonl", 1, "malformed"), ("c.jsonl", 10, "non_object")]
    assert sorted((os.path.basename(r.src_file), r.line_no, r.reason) for r in spark.read.parquet(f"{out}/rejects").collect()) == batch
    assert spark.read.parquet(f"{out}/lines").filter("status = 'kept'").count() == 31


def test_row_function(spark, tmp_path):
    loads = str(tmp_path)

    def load():
        import os
        import uuid

        open(os.path.join(loads, uuid.uuid4().hex), "w").close()
        return lambda rows: {"k": [k for k in rows["k"] for _ in range(k % 3)], "n": [len(rows)] * sum(k % 3 for k in rows["k"])}

    df = spark.range(500).selectExpr("id as k", "'unused' as u").repartition(16)
    got = map_rows(df, load, "k long, n int, none string", ["k"], batch_rows=10).collect()
    assert sorted(r.k for r in got) == sorted(k for k in range(500) for _ in range(k % 3))
    assert {(r.n, r.none) for r in got} == {(1, None)}
    # Once per worker process, not per task or batch.
    assert 1 <= len(os.listdir(loads)) <= 8
    for wrong in ({"other": [1]}, {"k": [1], "n": []}):
        with pytest.raises(Exception, match="not in the schema|different length"):
            map_rows(df, lambda wrong=wrong: lambda rows: wrong, "k long, n int").collect()
