from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptmill.functions.chat import ChatFormat, prompt_text
from promptmill.operators import context as ctx
from promptmill.operators.templates import (
    Template,
    TemplateError,
    is_valid_render,
    messages_from_text,
)

# One document with a closing literal after the value, one with a line break in the condition, and one
# whose last message ends in a mark for the answer.
SQL_ONLY = {
    "messages": [
        {"role": "system", "content": "Recipes as queries – one line each."},
        {"role": "user", "content": "Dish {{question}}{% if schema %} from [{{schema}}]{% endif %}, please"},
        {"role": "assistant", "content": "Cook {{ sql }}."},
    ]
}
TEXT_OR_SQL = {
    "messages": [
        {"role": "user", "content": "{{question}}?{% if schema %}\nPantry ({{schema}}){% endif %}"},
        {"role": "assistant", "content": "{{answer}}"},
    ]
}
INFERENCE = {
    "messages": [
        {"role": "system", "content": "Recipes."},
        {"role": "user", "content": "{% if schema %}[{{schema}}] {% endif %}{{question}} =>"},
    ]
}


def _records(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, raw string").withColumn(
        "rec", F.parse_json("raw")
    )


RULES = {"question": ctx.QUESTION_KEYS, "sql": ctx.SQL_KEYS, "answer": ctx.ANSWER_KEYS, "schema": ctx.SCHEMA_KEYS}


def _model_context(rec):
    """The field rules as a table: the first value that counts, else the last one there is."""
    found = {}
    for name, keys in RULES.items():
        values = [rec.get(k) for k in keys]
        found[name] = next(filter(None, values), values[-1])
    found["schema"] = found["schema"] or ""
    return found


def _model_raw(document, values):
    """What raw rendering gives, for the fixed layouts above."""
    text = json.dumps(document)
    start = text.find("{% if schema %}")
    end = text.find("{% endif %}")
    inner = text[start + len("{% if schema %}") : end]
    text = text[:start] + (inner if values["schema"] else "") + text[end + len("{% endif %}") :]
    for name, value in values.items():
        for mark in ("{{%s}}" % name, "{{ %s }}" % name):
            text = text.replace(mark, str(value))
    return text


KEYS = [
    "question", "NATURAL_LANGUAGE_QUESTION", "natural_language_question", "sql", "POSTGRESQL_QUERY",
    "answer", "query", "schema", "SCHEMA_JSON", "schema_json",
]
scalars = st.sampled_from(
    [None, "", "0", "false", "[]", "{}", "null", "x é", 0, 7, -3, 0.0, 1.5, 100.0, True, False, [], {}, [None], {"b": 1, "a": [True, "q"]}]
)
records = st.dictionaries(st.sampled_from(KEYS), scalars, max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(records, min_size=60, max_size=120))
def test_raw_render_equals_the_python_model(spark, recs):
    fields = ctx.read_fields(_records(spark, [json.dumps(r) for r in recs]))
    df, context = fields.frame, ctx.training_context(fields, python_text=True)
    for document in (SQL_ONLY, TEXT_OR_SQL):
        template = Template(document)
        got = [r[1] for r in df.select("i", template.render_raw(context)).orderBy("i").collect()]
        assert got == [_model_raw(document, _model_context(r)) for r in recs]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(*[st.text(max_size=8)] * 3), min_size=40, max_size=80))
def test_safe_render_parses_back_to_the_input(spark, triples):
    df = spark.createDataFrame(
        [(i, *t) for i, t in enumerate(triples)], "i int, question string, sql string, schema string"
    )
    template = Template(SQL_ONLY)
    context = ctx.column_context(df, template.variables)
    rows = df.select(
        "i",
        template.render_safe(context).alias("text"),
        template.messages(context).alias("messages"),
        messages_from_text(template.render_safe(context)).alias("parsed"),
        template.prompt(context).alias("prompt"),
        prompt_text(template.messages(context)).alias("prompt2"),
    ).orderBy("i").collect()
    for row, (question, sql, schema) in zip(rows, triples):
        user = f"Dish {question}" + (f" from [{schema}]" if schema else "") + ", please"
        contents = [SQL_ONLY["messages"][0]["content"], user, f"Cook {sql}."]
        assert [m["content"] for m in json.loads(row.text)["messages"]] == contents
        assert [m.content for m in row.messages] == contents
        assert row.parsed == row.messages
        assert row.prompt == row.prompt2 == "\n".join(contents)


def test_safe_and_raw_text_are_equal_for_plain_values(spark):
    fields = ctx.read_fields(_records(spark, ['{"question": "q é", "sql": "select 1", "schema": "s"}']))
    df, context = fields.frame, ctx.training_context(fields)
    t = Template(SQL_ONLY)
    raw, safe = df.select(t.render_raw(context), t.render_safe(context)).first()
    assert raw == safe


def test_raw_render_can_break_json(spark):
    df = spark.createDataFrame([('say "hi"',), ("plain",), ("two\nlines",), ("back\\dslash",)], "question string")
    t = Template(INFERENCE)
    assert t.variables == ["question", "schema"]
    rendered = t.render_raw(ctx.column_context(df, t.variables))
    assert [r[0] for r in df.select(is_valid_render(rendered)).collect()] == [False, True, False, False]
    quarantined = df.select(messages_from_text(rendered, "quarantine").alias("m")).collect()
    assert [r.m is None for r in quarantined] == [True, False, True, True]
    with pytest.raises(Exception, match="no messages"):
        df.select(messages_from_text(rendered)).collect()


def test_evaluation_context_has_no_aliases(spark):
    records = _records(
        spark,
        ['{"NATURAL_LANGUAGE_QUESTION": "n"}', '{"question": null, "schema": []}', '{"question": "q", "schema": "s"}'],
    )
    fields = ctx.read_fields(records, ["question", "schema"])
    df = fields.frame
    t = Template({"messages": [{"content": "{% if schema %}S{{schema}}{% endif %}Q{{question}}"}]})
    context = ctx.evaluation_context(fields, t.variables)
    raw = df.select("i", messages_from_text(t.render_raw(context))[0]["content"]).orderBy("i").collect()
    assert [r[1] for r in raw] == ["Q", "QNone", "SsQq"]
    assert [r[1] for r in df.select("i", t.prompt(context)).orderBy("i").collect()] == ["Q", "Q", "SsQq"]


def test_expected_answer_and_record_text(spark):
    df = _records(spark, ['{"answer": " a ", "sql": "s"}', '{"answer": "", "sql": "s "}', '{"text": "t"}', '{"text": 0}'])
    fields = ctx.read_fields(df, ctx.EXPECTED_KEYS)
    got = fields.frame.select("i", ctx.expected_answer(fields), ctx.record_text(F.col("rec"))).orderBy("i").collect()
    assert [r[1] for r in got] == ["a", "s", "", ""]
    assert [r[2] for r in got][2:] == ["t", '{"text":0}']


def test_context_struct(spark):
    fields = ctx.read_fields(_records(spark, ['{"query": "q1", "schema_json": {"b": 1, "a": 2}}']))
    row = fields.frame.select(ctx.context_struct(ctx.training_context(fields)).alias("c")).first().c
    assert row.asDict() == {"question": None, "sql": "q1", "answer": "q1", "schema": '{"b":1,"a":2}'}


@pytest.mark.parametrize(
    "source",
    ["{% for x in y %}", "{{ a|upper }}", "{# note #}", "{% if a %}x", "x{% endif %}", "{{ a", "{%- if a %}{% endif %}"],
)
def test_other_markup_is_refused(source):
    with pytest.raises(TemplateError):
        Template({"messages": [{"content": source}]})


def test_unknown_variable_and_nested_condition(spark):
    df = spark.createDataFrame([("1", ""), ("", "2"), ("1", "2")], "a string, b string")
    t = Template({"messages": [{"content": "{% if a %}A{% if b %}B{{b}}{% endif %}{% endif %}{{nope}}{% if nope %}!{% endif %}"}]})
    assert t.variables == ["a", "b", "nope"]
    context = ctx.column_context(df, ["a", "b"])
    assert [r[0] for r in df.select(t.prompt(context)).collect()] == ["A", "", "AB2"]


def test_chat_format_from_template(spark):
    df = spark.createDataFrame([("x",)], "question string")
    t = Template(INFERENCE)
    fmt = ChatFormat("<b>", "<", ">", "/", "<assistant>")
    assert (
        df.select(t.prompt(ctx.column_context(df, t.variables), fmt, True)).first()[0]
        == "<b><system>Recipes./<user>x =>/<assistant>"
    )
