"""Records, contexts and templates on whole tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.chat import prompt_text
from ..operators.context import (
    EXPECTED_KEYS,
    column_context,
    context_struct,
    evaluation_context,
    expected_answer,
    read_fields,
    record_text,
    training_context,
)
from ..operators.templates import Template, is_valid_render, messages_from_text
from ..plans.render import render_records, run_render
from ..session import scratch_path
from ..sinks.writers import write_config, write_lines
from ..sources.config import DatasetSpec, RenderSpec
from ..sources.records import line_numbers, lines_with_provenance, parse_records, read_lines, read_records
from .registry import query, table

SYSTEM = "You turn questions into SQL. Answer with one statement."
ASK = "{% if schema %}<tables>{{schema}}</tables>{% endif %}Wanted: {{question}}"

SQL_TEMPLATE = {
    "messages": [
        {"role": "system", "content": SYSTEM},
        {"role": "user", "content": ASK},
        {"role": "assistant", "content": "Statement = {{sql}};"},
    ]
}
ANSWER_TEMPLATE = {
    "messages": [
        {"role": "system", "content": "You answer in words or in SQL."},
        {"role": "user", "content": "{% if schema %}<tables>{{schema}}</tables>\n{% endif %}Wanted: {{question}}"},
        {"role": "assistant", "content": "{{answer}}"},
    ]
}
INFERENCE_TEMPLATE = {
    "messages": [
        {"role": "system", "content": SYSTEM},
        {"role": "user", "content": ASK + " Statement ="},
    ]
}

_SQL_OF_DOC = "'SELECT text FROM documents WHERE doc_id = ' || doc_id"
_USER_OF_DOC = "CASE WHEN lang = 'en' THEN '<tables>' || source || '</tables>' ELSE '' END || 'Wanted: ' || text"


def question_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as questions, English ones with a schema text."""
    return table(spark, folder, "documents").select(
        "doc_id",
        F.col("text").alias("question"),
        F.concat(F.lit("SELECT text FROM documents WHERE doc_id = "), F.col("doc_id")).alias("sql"),
        F.when(F.col("lang") == "en", F.col("source")).otherwise(F.lit("")).alias("schema"),
    )


@query(
    f"""SELECT doc_id, prompt_text, length(prompt_text) AS n_chars FROM (
        SELECT doc_id, '{SYSTEM}' || chr(10) || {_USER_OF_DOC} || chr(10) || 'Statement = ' || {_SQL_OF_DOC} || ';' AS prompt_text
        FROM documents)"""
)
def render_sql_prompt(spark, folder):
    rows = question_rows(spark, folder)
    template = Template(SQL_TEMPLATE)
    prompt = template.prompt(column_context(rows, template.variables))
    return rows.select("doc_id", prompt.alias("prompt_text")).withColumn("n_chars", F.length("prompt_text"))


@query(
    f"""SELECT doc_id, 3 AS n_messages,
        CASE WHEN lang = 'en' THEN '<tables>' || source || '</tables>' || chr(10) ELSE '' END || 'Wanted: ' || text AS user_text,
        {_SQL_OF_DOC} AS assistant_text FROM documents"""
)
def render_messages(spark, folder):
    """Messages as an array of structs, from the template that answers in words or SQL."""
    rows = question_rows(spark, folder).withColumnRenamed("sql", "answer")
    template = Template(ANSWER_TEMPLATE)
    built = rows.select("doc_id", template.messages(column_context(rows, template.variables)).alias("m"))
    return built.select(
        "doc_id",
        F.size("m").alias("n_messages"),
        F.col("m")[1]["content"].alias("user_text"),
        F.col("m")[2]["content"].alias("assistant_text"),
    )


@query(
    f"""SELECT page_id, 'user' AS role, 'Wanted: ' || html || ' Statement =' AS content,
        '{SYSTEM}' || chr(10) || 'Wanted: ' || html || ' Statement =' AS prompt_text FROM pages"""
)
def render_safe_json(spark, folder):
    """Markup full of quotes through JSON text and back, unchanged."""
    rows = table(spark, folder, "pages").select("page_id", F.col("html").alias("question"))
    template = Template(INFERENCE_TEMPLATE)
    text = template.render_safe(column_context(rows, template.variables))
    parsed = rows.select("page_id", messages_from_text(text).alias("m"))
    return parsed.select(
        "page_id",
        F.col("m")[1]["role"].alias("role"),
        F.col("m")[1]["content"].alias("content"),
        prompt_text(F.col("m")).alias("prompt_text"),
    )


@query(
    """SELECT conv_id, turn, 1 AS safe_ok, CASE WHEN json_valid('{"messages": [{"role": "user", "content": "Q: ' || question || '"}]}') THEN 1 ELSE 0 END AS raw_ok
    FROM (SELECT conv_id, turn, CASE role
        WHEN 'system' THEN replace(text, chr(10), ' ') || ' "quoted"'
        WHEN 'assistant' THEN replace(text, chr(10), '\\n')
        ELSE text END AS question FROM conversations)"""
)
def render_validity(spark, folder):
    """Which values break the JSON text when they are put in as they are."""
    flat = F.regexp_replace("text", "\n", " ")
    rows = table(spark, folder, "conversations").select(
        "conv_id",
        "turn",
        F.when(F.col("role") == "system", F.concat(flat, F.lit(' "quoted"')))
        .when(F.col("role") == "assistant", F.replace("text", F.lit("\n"), F.lit("\\n")))
        .otherwise(F.col("text"))
        .alias("question"),
    )
    template = Template({"messages": [{"role": "user", "content": "Q: {{question}}"}]})
    context = column_context(rows, template.variables)
    return rows.select(
        "conv_id",
        "turn",
        is_valid_render(template.render_safe(context)).cast("int").alias("safe_ok"),
        is_valid_render(template.render_raw(context)).cast("int").alias("raw_ok"),
    )


def event_records(spark: SparkSession, folder: str) -> DataFrame:
    """Events as JSON records whose fields are named, missing, null or empty by event type."""
    question = F.concat(F.lit("What happened in "), F.col("event_id"), F.lit("?"))
    sql = F.concat(F.lit("SELECT 1 FROM events WHERE event_id = "), F.col("event_id"))
    text = (
        F.when(F.col("event_type") == "view", F.to_json(F.struct("event_id", question.alias("question"), sql.alias("sql"), F.col("props").alias("schema"))))
        .when(F.col("event_type") == "click", F.to_json(F.struct("event_id", F.lit("").alias("question"), question.alias("NATURAL_LANGUAGE_QUESTION"), F.lit(0).alias("sql"), sql.alias("query"), F.array().alias("schema"), F.col("props").alias("schema_json"))))
        .when(F.col("event_type") == "error", F.to_json(F.struct("event_id", F.lit(False).alias("question"), question.alias("natural_language_question"), F.lit("").alias("answer"), sql.alias("POSTGRESQL_QUERY"), F.lit("0").alias("SCHEMA_JSON"))))
        .when(F.col("event_type") == "purchase", F.concat(F.lit('{"question": null, "sql": [], "query": null, "event_id": '), F.col("event_id"), F.lit("}")))
        .otherwise(F.to_json(F.struct("event_id", question.alias("question"), sql.alias("answer"), F.lit("kept").alias("SCHEMA_JSON"), F.lit("not used").alias("schema_json"))))
    )
    return table(spark, folder, "events").select(text.alias("value"))


_EVENT_QUESTION = "'What happened in ' || event_id || '?'"
_EVENT_SQL = "'SELECT 1 FROM events WHERE event_id = ' || event_id"


@query(
    f"""SELECT event_id,
        CASE WHEN event_type <> 'purchase' THEN {_EVENT_QUESTION} END AS question,
        CASE WHEN event_type <> 'purchase' THEN {_EVENT_SQL} END AS sql,
        CASE WHEN event_type <> 'purchase' THEN {_EVENT_SQL} END AS answer,
        CASE event_type WHEN 'view' THEN props WHEN 'click' THEN props WHEN 'error' THEN '0' WHEN 'signup' THEN 'kept' ELSE '' END AS schema
        FROM events"""
)
def alias_coalesce(spark, folder):
    records = parse_records(lines_with_provenance(event_records(spark, folder), "value"))
    fields = read_fields(records)
    return fields.frame.select(
        F.variant_get("rec", "$.event_id", "bigint").alias("event_id"),
        context_struct(training_context(fields)).alias("c"),
    ).select("event_id", "c.*")


@query(
    f"""SELECT event_id,
        '{SYSTEM}' || chr(10) || CASE WHEN event_type = 'view' THEN '<tables>' || props || '</tables>' ELSE '' END || 'Wanted: '
        || CASE WHEN event_type IN ('view', 'signup') THEN {_EVENT_QUESTION} WHEN event_type = 'error' THEN 'False' ELSE '' END || ' Statement =' AS prompt_text,
        CASE WHEN event_type IN ('view', 'signup') THEN {_EVENT_SQL} WHEN event_type = 'click' THEN '0' WHEN event_type = 'purchase' THEN '[]' ELSE '' END AS sql_text,
        CASE WHEN event_type IN ('view', 'signup') THEN {_EVENT_SQL} ELSE '' END AS expected
        FROM events"""
)
def evaluation_items(spark, folder):
    """Exact field names only, missing fields empty; expected answer from ``answer`` or ``sql``."""
    records = parse_records(lines_with_provenance(event_records(spark, folder), "value"))
    template = Template(INFERENCE_TEMPLATE)
    fields = read_fields(records, [*template.variables, *EXPECTED_KEYS])
    context = evaluation_context(fields, template.variables)
    first = F.coalesce(
        *[F.variant_get("rec", f"$.{k}", "string") for k in ("sql", "answer")], F.lit("")
    )
    return fields.frame.select(
        F.variant_get("rec", "$.event_id", "bigint").alias("event_id"),
        template.prompt(context).alias("prompt_text"),
        first.alias("sql_text"),
        expected_answer(fields).alias("expected"),
    )


@query(
    """SELECT event_id, CASE WHEN event_type = 'error' THEN '{"event_id":' || event_id || '}' ELSE event_type || ' ' || props END AS text FROM events"""
)
def record_fallback_text(spark, folder):
    """Records without messages: their text, or the whole record."""
    text = F.when(F.col("event_type") != "error", F.concat_ws(" ", "event_type", "props"))
    lines = table(spark, folder, "events").select(F.to_json(F.struct("event_id", text.alias("text"))).alias("value"))
    records = parse_records(lines_with_provenance(lines, "value"))
    return records.select(
        F.variant_get("rec", "$.event_id", "bigint").alias("event_id"), record_text(F.col("rec")).alias("text")
    )


_READ_BACK = "SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, value FROM events"


def _props_records(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select(
        F.concat(
            F.lit('{"event_id": '), F.col("event_id"), F.lit(', "event_type": "'), F.col("event_type"),
            F.lit('", "value": '), F.col("value"), F.lit(', "note": "a } in \\"text\\"", "props": '), F.col("props"), F.lit("}"),
        ).alias("value")
    )


def _props_of(records: DataFrame) -> DataFrame:
    return records.select(
        F.variant_get("rec", "$.event_id", "bigint").alias("event_id"),
        F.variant_get("rec", "$.event_type", "string").alias("event_type"),
        F.variant_get("rec", "$.props.k", "string").alias("k"),
        F.variant_get("rec", "$.value", "double").alias("value"),
    )


@query(_READ_BACK)
def json_lines_records(spark, folder):
    """Write events as JSON lines to the shared folder, read them as records."""
    path = scratch_path(spark, "lines")
    write_lines(_props_records(spark, folder), F.col("value"), path)
    return _props_of(read_records(spark, path))


def _as_array(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Turn the lines of one part file into one JSON array."""
    opening = "["
    for batch in batches:
        values = batch["value"].tolist()
        yield pd.DataFrame({"value": [(opening if i == 0 else ", ") + v for i, v in enumerate(values)]})
        if values:
            opening = ", "
    yield pd.DataFrame({"value": ["[]" if opening == "[" else "]"]})


@query(_READ_BACK)
def json_array_records(spark, folder):
    """Write events as files of one JSON array each, read them as records."""
    path = scratch_path(spark, "arrays")
    write_lines(_props_records(spark, folder).mapInPandas(_as_array, "value string"), F.col("value"), path)
    return _props_of(read_records(spark, path))


@query(
    f"""SELECT doc_id, {_USER_OF_DOC} AS user_text, 'Statement = ' || {_SQL_OF_DOC} || ';' AS assistant_text FROM documents"""
)
def render_job(spark, folder):
    """Records to rendered lines on disk, and read back as JSON."""
    lines = question_rows(spark, folder).select(
        F.to_json(F.struct("doc_id", "question", F.col("sql").alias("POSTGRESQL_QUERY"), F.col("schema").alias("SCHEMA_JSON"))).alias("value")
    )
    records = parse_records(lines_with_provenance(lines, "value"))
    path = scratch_path(spark, "rendered")
    write_lines(render_records(records, Template(SQL_TEMPLATE)), F.col("rendered"), path)
    read = read_records(spark, path, layout="lines")
    content = [F.variant_get("rec", f"$.messages[{i}].content", "string") for i in (1, 2)]
    return read.select(
        F.regexp_extract(content[1], "= ([0-9]+);$", 1).cast("bigint").alias("doc_id"),
        content[0].alias("user_text"),
        content[1].alias("assistant_text"),
    )


@query(
    """SELECT what, n FROM (
        SELECT 'rendered' AS what, count(*) AS n FROM documents
        UNION ALL SELECT 'invalid', count(*) FILTER (doc_id % 3 = 0 OR contains(source, chr(34))) FROM documents
        UNION ALL SELECT 'good lines', count(*) FILTER (NOT (doc_id % 3 = 0 OR contains(source, chr(34)))) FROM documents
        UNION ALL SELECT 'bad lines', count(*) FILTER (doc_id % 3 = 0 OR contains(source, chr(34))) FROM documents)"""
)
def render_sorted_out(spark, folder):
    """The render job on raw values that break the JSON of some texts: its counts, and the lines it wrote apart."""
    docs = table(spark, folder, "documents")
    question = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('a "'), F.col("source"))).otherwise(F.col("source"))
    source, out, template = (scratch_path(spark, n) for n in ("records", "rendered", "template"))
    lines = F.to_json(F.struct(question.alias("question"), F.col("doc_id").cast("string").alias("sql"), F.col("lang").alias("schema")))
    docs.select(lines).write.text(source)
    write_config(spark, SQL_TEMPLATE, template)
    run_render(spark, RenderSpec(template, (DatasetSpec(source, out),)), mode="raw", layout="lines", on_error="quarantine")
    written = spark.read.schema("value string, status string").text(out).groupBy("status").agg(F.count("*").alias("n"))
    written = written.select(F.concat("status", F.lit(" lines")).alias("what"), "n")
    return spark.read.schema("what string, n long").json(f"{out}.counts").unionByName(written)


LINES_PER_FILE = 64


@query(
    f"""SELECT doc_id, i // {LINES_PER_FILE} AS part, i % {LINES_PER_FILE} + 1 AS line_no
        FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)"""
)
def ordered_lines(spark, folder):
    """Records rendered in input order to files of equal numbers of lines: file and line of each."""
    source, out = scratch_path(spark, "sorted"), scratch_path(spark, "ordered")
    docs = table(spark, folder, "documents").select("doc_id", "text").repartitionByRange(7, "doc_id").sortWithinPartitions("doc_id")
    docs.select(F.to_json(F.struct("doc_id", "text"))).write.text(source)
    write_lines(read_records(spark, source, layout="lines"), F.col("raw"), out, ordered=True, lines_per_file=LINES_PER_FILE)
    lines = read_lines(spark, out)
    part = F.regexp_extract("src_file", "part-([0-9]+)-", 1).cast("bigint").alias("part")
    doc_id = F.get_json_object("value", "$.doc_id").cast("bigint").alias("doc_id")
    return line_numbers(lines, lines).select(doc_id, part, "line_no")
