from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptmill.functions import text as t
from promptmill.functions.chat import ChatFormat, prompt_text

SLOW = dict(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def _apply(spark, values, *columns):
    df = spark.createDataFrame([(v,) for v in values], "t string")
    return [tuple(r) for r in df.select(*columns).collect()]


@settings(**SLOW)
@given(st.lists(st.text(alphabet=t.PY_WHITESPACE + "aé​", max_size=8), min_size=50, max_size=100))
def test_strip_like_python(spark, values):
    got = _apply(spark, values, t.py_strip(F.col("t")).alias("s"), t.py_rstrip(F.col("t")).alias("r"))
    assert got == [(v.strip(), v.rstrip()) for v in values]


def _cut(text, stops):
    places = [text.find(s) for s in stops]
    first = next((p for p in places if p >= 0), len(text))
    return text[:first]


def _halt(text, stops):
    for end in range(1, len(text) + 1):
        if any(text[:end].endswith(s) for s in stops):
            return text[:end]
    return text


@settings(**SLOW)
@given(
    st.lists(st.text(alphabet="`;\nab", max_size=14), min_size=50, max_size=100),
    st.lists(st.text(alphabet="`;\na", min_size=1, max_size=3), max_size=3),
)
def test_stop_sequences(spark, values, stops):
    c = F.col("t")
    got = _apply(
        spark, values, t.cut_at_stop(c, stops).alias("cut"), t.halt_at_stop(c, stops).alias("halt")
    )
    assert got == [(_cut(v, stops), _halt(v, stops)) for v in values]


def test_stop_list_order_beats_position(spark):
    assert _apply(spark, ["a;b#c"], t.cut_at_stop(F.col("t"), ["#", ";"])) == [("a;b",)]


def test_empty_stop_is_refused(spark):
    for f in (t.cut_at_stop, t.halt_at_stop):
        with pytest.raises(ValueError):
            f(F.col("t"), [""])


def test_safe_name_and_stamp(spark):
    names = ["base/model v1.2", "ä-Ö_9", "", "日本 ½"]
    expected = ["".join(c if c.isalnum() or c in "-_" else "_" for c in n) for n in names]
    assert [r[0] for r in _apply(spark, names, t.safe_name(F.col("t")))] == expected
    stamp = spark.sql("select timestamp'2026-01-31 23:59:58' ts").select(t.run_stamp(F.col("ts"))).first()[0]
    assert stamp == "20260131_235958"


MESSAGES = "array<struct<role:string,content:string>>"


def test_prompt_text(spark):
    df = spark.createDataFrame(
        [([("system", "S"), ("user", ""), ("assistant", "A")],), ([],)], f"m {MESSAGES}"
    )
    assert [r[0] for r in df.select(prompt_text(F.col("m"))).collect()] == ["S\n\nA", ""]
    fmt = ChatFormat("<s>", "[", "]", "|", "[assistant]")
    got = [r[0] for r in df.select(prompt_text(F.col("m"), fmt, add_generation_prompt=True)).collect()]
    assert got == ["<s>[system]S|[user]|[assistant]A|[assistant]", "<s>[assistant]"]


def test_null_content(spark):
    df = spark.createDataFrame([([("u", "a"), ("u", None), ("u", "b")],)], f"m {MESSAGES}")
    with pytest.raises(Exception, match="content is null"):
        df.select(prompt_text(F.col("m"))).collect()
    assert df.select(prompt_text(F.col("m"), null_content="empty")).first()[0] == "a\n\nb"
