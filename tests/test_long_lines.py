"""Lines beyond the limits of the JVM's parser, and the second parser against ``json.loads``."""

from __future__ import annotations

import json
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import VariantVal

from promptmill.functions.json_variant import _array, variant_bytes
from promptmill.sources.chat import parse_chat
from promptmill.sources.records import lines_with_provenance, parse_records

_VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-(2**70), 2**70) | st.text() | st.decimals(allow_nan=False, allow_infinity=False, places=3).map(float),
    lambda inner: st.lists(inner, max_size=4) | st.dictionaries(st.text(max_size=5), inner, max_size=4),
    max_leaves=20,
)


@settings(max_examples=200, deadline=None)
@given(_VALUES)
def test_values_come_back(value):
    text = json.dumps(value)
    assert json.loads(VariantVal(*variant_bytes(text)).toJson(), parse_float=float) == json.loads(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='[]{},:"\\ \n01-.eEtrufalsn\x01é', max_size=12))
def test_refuses_what_json_refuses(text):
    def refuse(_):
        raise ValueError

    try:
        json.loads(text, parse_constant=refuse)
        valid = text == text.strip("\x0b\x0c")
    except ValueError:
        valid = False
    assert (variant_bytes(text) is not None) == valid


_BRACKETS = st.text(alphabet="[]", max_size=12) | st.text(alphabet='[]{},:"a1 ', max_size=14)


@settings(max_examples=500, deadline=None)
@given(_BRACKETS, st.integers(0, 400), st.integers(-1, 1))
def test_runs_of_brackets(inner, depth, missing):
    text = "[" * depth + inner + " ]" * (depth + missing)
    try:
        value = json.loads(text)
    except ValueError:
        assert variant_bytes(text) is None
        return
    if len(text) < 20:
        assert json.loads(VariantVal(*variant_bytes(text)).toJson()) == value
    # The same bytes as level by level: a comment of white space between brackets is no run.
    levels = inner.strip() or "[]"
    if depth and not missing and levels == "[]":
        expected = variant_bytes("[]")[0]
        for _ in range(depth):
            expected = _array([expected])
        assert variant_bytes("[" * depth + "[]" + "]" * depth)[0] == expected


def test_deep_lists_take_linear_time():
    def seconds(depth):
        began = time.process_time()
        assert len(variant_bytes('{"a":' + "[" * depth + "1" + "]" * depth + "}")[0]) > 4 * depth
        return time.process_time() - began

    seconds(1000)
    assert seconds(400_000) < 5


_LONG = [
    json.dumps({"messages": [{"role": "user", "content": "y" * 25_000_000}]}),
    '{"messages":[{"role":"user","content":"n"}],"n":' + "7" * 1500 + "}",
    '{"messages":[{"role":"user","content":"deep"}],"d":' + "[" * 1500 + "]" * 1500 + "}",
]


def _lines(spark, lines):
    return lines_with_provenance(spark.createDataFrame([(x,) for x in lines], "value string"), "value")


def test_chat_lines_of_any_length_and_depth(spark):
    rows = parse_chat(_lines(spark, [*_LONG, "[" * 2000, '{"a":' + "1" * 1500 + "} x", "  ", "{bad", "[]"]))
    rows = rows.select("status", "reason", F.expr("get(messages, 0).content").alias("c")).orderBy("status", F.length("c"), "reason")
    got = [(r.status, r.reason, None if r.c is None else len(r.c)) for r in rows.collect()]
    kept = [("kept", None, None), ("kept", None, 1), ("kept", None, 4), ("kept", None, 25_000_000)]
    assert got == kept + [("rejected", "malformed", None)] * 3


def test_records_of_any_length_and_depth(spark):
    rows = parse_records(_lines(spark, [*_LONG, '{"messages":[{"content":"z"}]}']))
    got = rows.select(F.expr("length(try_variant_get(rec, '$.messages[0].content', 'string'))").alias("n")).collect()
    assert sorted(r.n for r in got) == [1, 1, 4, 25_000_000]
