from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from promptmill.operators import tokens as tk
from promptmill.operators.batches import batch_layout, with_layout

TEXTS = ["Hello, wörld! hello", "", "a  b\tc", "x_1 + 2 = λ"]


def _words(text):
    return re.findall(r"\w+|[^\w \t\r\n]", text)


def test_hashed_ids(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = [r[1] for r in df.select("i", tk.hashed_ids(F.col("t"), 1000, reserved=3)).orderBy("i").collect()]

    def id_of(word):
        return int(np.uint64(xxhash.xxh64_intdigest(word, seed=42)).astype(np.int64)) % 997 + 3

    assert got == [[id_of(w) for w in _words(t)] for t in TEXTS]


def test_user_encoder(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    vocabulary = {"a": 1, "b": 2, "hello": 3}
    ids = tk.encoder_ids(F.col("t"), lambda: tk.vocabulary_encoder(vocabulary, 0, r"\w+"))
    got = [r[1] for r in df.select("i", ids).orderBy("i").collect()]
    assert got == [[vocabulary.get(w, 0) for w in re.findall(r"\w+", t)] for t in TEXTS]


def test_tokenize_truncates_pads_and_labels(spark):
    df = spark.createDataFrame([(1, [5, 6, 7, 8]), (2, [9]), (3, [])], "k int, ids array<int>")
    rows = tk.tokenize(df, F.col("ids"), ["k"], max_length=3, pad_id=0).orderBy("k").collect()
    assert rows[0].asDict() == {
        "k": 1, "input_ids": [5, 6, 7], "attention_mask": [1, 1, 1], "n_tokens": 3, "labels": [5, 6, 7],
    }
    assert (rows[1].input_ids, rows[1].attention_mask, rows[1].n_tokens) == ([9, 0, 0], [1, 0, 0], 1)
    assert (rows[2].input_ids, rows[2].attention_mask) == ([0, 0, 0], [0, 0, 0])
    plain = tk.tokenize(df, F.col("ids"), ["k"], add_labels=False).orderBy("k").collect()
    assert plain[0].input_ids == [5, 6, 7, 8] and plain[1].attention_mask == [1]
    assert "labels" not in plain[0].asDict()
    with pytest.raises(ValueError):
        tk.tokenize(df, F.col("ids"), ["k"], pad_id=0)


@pytest.mark.parametrize("digits", [1, 4])
@pytest.mark.parametrize("partitions", [1, 7])
def test_layout_equals_a_global_sort(spark, digits, partitions):
    n, epochs, batch, accumulate = 203, 2, 4, 8
    df = spark.range(n).select("id", (F.col("id") % 13).cast("int").alias("len")).repartition(partitions)
    got = {
        (r.epoch, r.id): (r.row_index, r.batch_id, r.step_id, r.batch_length)
        for r in batch_layout(df, ["id"], "len", batch, accumulate, epochs, 7, digits).collect()
    }
    expected = {}
    for e in range(epochs):
        order = sorted(range(n), key=lambda i: hashlib.md5(f"7|{e}|{i}".encode()).hexdigest())
        for at, i in enumerate(order):
            b = at // batch
            longest = max(j % 13 for j in order[b * batch : (b + 1) * batch])
            expected[e, i] = (at, b, b // accumulate, longest)
    assert got == expected
    orders = [[i for (e, i), v in sorted(got.items(), key=lambda x: x[1][0]) if e == k] for k in (0, 1)]
    assert orders[0] != orders[1]


def test_collate_pads_to_the_longest_of_the_batch(spark):
    df = spark.createDataFrame([(1, [5, 2]), (2, [7, 8, 9]), (3, [2])], "k int, ids array<int>")
    tokens = tk.tokenize(df, F.col("ids"), ["k"], add_labels=False)
    layout = batch_layout(tokens, ["k"], "n_tokens", batch_size=3)
    rows = tk.collate(with_layout(tokens, layout, ["k"]), pad_id=2).orderBy("k").collect()
    assert [r.input_ids for r in rows] == [[5, 2, 2], [7, 8, 9], [2, 2, 2]]
    assert [r.attention_mask for r in rows] == [[1, 1, 0], [1, 1, 1], [1, 0, 0]]
    assert [r.labels for r in rows] == [[5, -100, -100], [7, 8, 9], [-100, -100, -100]]


def test_layout_plan_has_no_single_partition_sort_of_rows(spark):
    df = spark.range(100).select("id", F.lit(3).alias("len"))
    plan = batch_layout(df, ["id"], "len", 2)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("[epoch" in w.split("],")[1] for w in windows)
