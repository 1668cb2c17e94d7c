from __future__ import annotations

import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from promptmill.sources import json_array
from promptmill.sources.records import concat_sources, in_input_order, read_records


def _records(n, rng):
    for i in range(n):
        yield {
            "question": f'q{i} "quoted" \\ {{brace}} ]}}, {rng.choice("abc")}\n{"é" * rng.randrange(4)}',
            "n": i,
            "nested": {"a": [1, {"b": "}"}], "c": {}} if i % 5 == 0 else None,
            "pad": "x" * rng.randrange(60),
        }


def _raw(df):
    return [json.loads(r.raw) for r in in_input_order(df).collect()]


@pytest.mark.parametrize("indent", [None, 1, "wide"])
@pytest.mark.parametrize("split_bytes", [97, 700, 134217728])
def test_array_equals_json_load(spark, tmp_path, indent, split_bytes):
    rng = random.Random(f"{indent}{split_bytes}")
    data = list(_records(30, rng))
    path = tmp_path / "data.json"
    text = json.dumps(data, indent=None if indent == "wide" else indent, ensure_ascii=False)
    if indent == "wide":
        text = text.replace('}, {"question"', '} \n ,\r\n  {"question"') + " \n"
    path.write_text(text, newline="")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert _raw(read_records(spark, str(path))) == data
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("split_bytes", [7, 23, 64])
def test_tiny_splits_between_odd_strings(spark, tmp_path, split_bytes):
    rng = random.Random(split_bytes)
    signs = ["}", "{", "]", "[", '"', "\\", ",", ":", "\n", "é", " "]
    data = [[]]
    for n in (1, 2, 9):
        data.append([{"".join(rng.choices(signs, k=rng.randrange(6))): rng.choice([{}, [{}, [[]]], "}" * 9, "\\" * 3])} for _ in range(n)])
    data.append([{}, {}, {"a": {"b": {"c": "]},{"}}}])
    for i, rows in enumerate(data):
        (tmp_path / f"{i}.json").write_text(json.dumps(rows, ensure_ascii=False, indent=rng.choice([None, 1])))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert _raw(read_records(spark, str(tmp_path))) == [r for rows in data for r in rows]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_array_without_broadcast(spark, tmp_path, monkeypatch):
    data = list(_records(30, random.Random(5)))
    path = tmp_path / "data.json"
    path.write_text(json.dumps(data))
    monkeypatch.setattr(json_array, "MAX_BROADCAST_SPLITS", 0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        assert _raw(read_records(spark, str(path))) == data
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize(
    "text",
    [
        '[{"a":1}',
        '[{"a":1}]}',
        '[{"a":1}] x',
        '[{"a":1}] {"b":2}',
        '[{"a":1} {"b":2}]',
        '[{"a":1},]',
        '[,{"a":1}]',
        '[{"a":1},,{"b":2}]',
        '[{"a":1},5]',
        '[5]',
        '[[{"a":1}]]',
        '[{"a":1}]]',
        '[{"a":"x}]',
        '[{"a":tru}]',
        "[",
        "[]}",
        "[]]",
    ],
)
def test_malformed_array_ends_the_job(spark, tmp_path, text):
    path = tmp_path / "bad.json"
    path.write_text(text)
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_records(spark, str(path)).collect()


def test_layout_is_chosen_by_first_character(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1}, {"x": 2}]')
    (tmp_path / "b é%20.json").write_text('{"x": 3}\n\n  \n{"x": 4}\n')
    (tmp_path / "c.json").write_text("")
    (tmp_path / "d.json").write_text("[]")
    got = read_records(spark, str(tmp_path))
    assert [r["x"] for r in _raw(got)] == [1, 2, 3, 4]
    assert _raw(read_records(spark, str(tmp_path / "c.json"))) == []
    assert _raw(read_records(spark, str(tmp_path / "d.json"))) == []
    # White space before the bracket makes it a line file, whose record is then no object.
    (tmp_path / "e.json").write_text(' [{"x": 1}]')
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_records(spark, str(tmp_path / "e.json")).collect()


@pytest.mark.parametrize("line", ["{bad", '{"a":1} x', "5", "[]", "null"])
def test_strict_lines(spark, tmp_path, line):
    path = tmp_path / "bad.jsonl"
    path.write_text('{"a": 1}\n' + line + "\n")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_records(spark, str(path), layout="lines").collect()


def test_concat_keeps_order_and_duplicates(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n{"x": 1}\n')
    (tmp_path / "b.jsonl").write_text('{"x": 0}\n')
    frames = [read_records(spark, str(tmp_path / n)) for n in ("b.jsonl", "a.jsonl", "b.jsonl")]
    assert [r["x"] for r in _raw(concat_sources(frames))] == [0, 1, 1, 0]
    with pytest.raises(IndexError):
        concat_sources([])
