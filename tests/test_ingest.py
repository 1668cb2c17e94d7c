from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptmill.functions.variants import strict_json
from promptmill.sources import chat
from promptmill.sources.records import lines_with_provenance

FULL = '{"messages":[{"role":"user","content":"a"},{"content":"b","role":"x","k":1}],"extra":1}'

# (line, kept messages or None, reason, no_messages, n_invalid)
MATRIX = [
    (FULL, [("user", "a"), ("x", "b")], None, False, 0),
    (
        '[{"role":"user","content":"bare"},{"role":"assistant","content":"list"}]',
        [("user", "bare"), ("assistant", "list")],
        None,
        False,
        0,
    ),
    ('{"messages":[{"role":"u"},"bad",5,{"content":null}]}', [("u", ""), ("", None)], None, False, 2),
    ('{"messages":"notalist"}', [], None, True, 0),
    ('{"messages":null}', [], None, True, 0),
    ('{"nomsg":1}', [], None, True, 0),
    ('{"messages":[]}', [], None, False, 0),
    ('{"messages":[{}]}', [("", "")], None, False, 0),
    ("[]", [], None, False, 0),
    ('"str"', None, "non_object", False, 0),
    ("5", None, "non_object", False, 0),
    ("null", None, "non_object", False, 0),
    ("{bad", None, "malformed", False, 0),
    ("{'a':1}", None, "malformed", False, 0),
    ('{"a":1} x', None, "malformed", False, 0),
    ('{"a":1}],[1', None, "malformed", False, 0),
    ('{"a":1},{"b":2}', None, "malformed", False, 0),
    ('{"a":"q\\d"}', None, "malformed", False, 0),
    ('{"a":"x\ty"}', None, "malformed", False, 0),
    ('﻿{"a":1}', None, "malformed", False, 0),
    ('{"a":1,"a":2}', [], None, True, 0),
    ('{"a":1e400}', [], None, True, 0),
    ('{"a":' + "1" * 45 + "}", [], None, True, 0),
    (" " + '{"messages":[]}' + " ", [], None, False, 0),
]


def test_ingest_matrix(spark):
    lines = spark.createDataFrame([(i, m[0]) for i, m in enumerate(MATRIX)], "n int, value string")
    got = {r.n: r for r in chat.parse_chat(lines).collect()}
    assert len(got) == len(MATRIX)
    for i, (line, messages, reason, no_messages, n_invalid) in enumerate(MATRIX):
        row = got[i]
        assert row.reason == reason, line
        assert row.status == ("kept" if reason is None else "rejected"), line
        assert (row.no_messages, row.n_invalid) == (no_messages, n_invalid), line
        if reason is None:
            assert [(m.role, m.content) for m in row.messages] == messages, line
            assert row.line is None
        else:
            assert row.line == line


def test_blank_lines_are_skipped_silently(spark):
    lines = spark.createDataFrame([("",), ("  ",), (" \x1f",), ("{}",)], "value string")
    assert chat.parse_chat(lines).count() == 1


def test_files_line_numbers_and_counts(spark, tmp_path):
    one = tmp_path / "one.jsonl"
    two = tmp_path / "two.jsonl"
    rows = [FULL if i % 3 else ("{bad" if i % 2 else "7") for i in range(5000)]
    rows[10] = rows[11] = ""
    one.write_text("\n".join(rows) + "\n")
    two.write_text('{"nomsg":1}\r\n\r\n5\r\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = chat.chat_lines(spark, [str(one), str(two)])
        assert lines.select("block_start").distinct().count() > 5
        parsed = chat.parse_chat(lines)
        got = {
            (r.src_idx, r.line_no, r.reason, r.line)
            for r in chat.rejected_with_line_numbers(lines, parsed).collect()
        }
        counts = {(r.src_idx, r.what): r.n for r in chat.ingest_counts(parsed).collect()}
        ordered = [
            r.src_idx
            for r in chat.read_chat(spark, [str(one), str(two)]).select("src_idx").collect()
        ]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    expected = {
        (0, i + 1, "malformed" if r == "{bad" else "non_object", r)
        for i, r in enumerate(rows)
        if r in ("{bad", "7")
    }
    assert got == expected | {(1, 3, "non_object", "5")}
    assert counts[(0, "malformed")] == sum(r == "{bad" for r in rows)
    assert counts[(0, "non_object")] == rows.count("7")
    assert counts[(0, "kept")] == rows.count(FULL)
    assert counts[(1, "no_messages")] == 1 and counts[(1, "kept")] == 1
    assert len(ordered) == rows.count(FULL) + 1
    with pytest.raises(IndexError):
        chat.read_chat(spark, [])


json_like = st.text(alphabet='{}[]",:\\ abn01-.e\n\té', max_size=12)
fragments = st.lists(
    st.sampled_from(['{', '}', '[', ']', '"a"', ':', ',', '1', 'null', 'true', '""', ' ', '-0', '1e5', '\\', '"']),
    max_size=8,
).map("".join)


def _loads(text):
    try:
        json.loads(text)
        return True
    except ValueError:
        return False


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(json_like, fragments), min_size=100, max_size=200))
def test_strict_json_agrees_with_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.ok for r in df.select(strict_json(F.col("t")).isNotNull().alias("ok")).collect()]
    assert got == [_loads(t) for t in texts]


def test_any_frame_of_lines_is_a_source(spark):
    df = spark.createDataFrame([(FULL,)], "text string")
    assert chat.kept(chat.parse_chat(lines_with_provenance(df, "text"))).count() == 1
