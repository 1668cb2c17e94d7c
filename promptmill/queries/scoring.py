"""Rosters, predictions, verdicts and scores on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.links import check_links
from ..operators.predict import generate, predict_roster
from ..operators.scoring import (
    clean_prediction,
    exact_match,
    join_predictions,
    pair_with_models,
    score_models,
    with_verdicts,
)
from ..plans.evaluate import run_evaluate
from ..session import materialize, scratch_path
from ..sinks.writers import read_run_log, write_config, write_run_log
from ..sources.config import EvaluateSpec, ModelSpec
from .registry import query, table

MODELS = (
    ModelSpec("base/alpha"),
    ModelSpec("base/beta", "tuned", ("first", "second")),
    ModelSpec("base/gamma", "idle"),
)

_SQL = "'SELECT o_totalprice FROM orders WHERE o_orderkey = ' || o_orderkey"


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """One evaluation item per order."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("item_id"),
        "o_orderstatus",
        "o_orderpriority",
        F.concat(F.lit("SELECT o_totalprice FROM orders WHERE o_orderkey = "), F.col("o_orderkey")).alias("expected"),
    )


def stored_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions of the first two models: right, empty, hot and wrong ones."""
    items = order_items(spark, folder)
    alpha = items.filter(F.col("o_orderstatus") != "P").select(
        F.lit(0).alias("model_idx"),
        "item_id",
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.col("expected"), F.lit("\n")))
        .otherwise(F.lit(""))
        .alias("prediction"),
    )
    beta = items.select(
        F.lit(1).alias("model_idx"),
        "item_id",
        F.when(F.col("o_orderstatus") == "F", F.concat(F.col("expected"), F.lit(";")))
        .when(F.col("o_orderstatus") == "P", F.lit("SELECT 1"))
        .otherwise(F.col("expected"))
        .alias("prediction"),
    )
    return alpha.unionByName(beta)


def scored_predictions(spark: SparkSession, folder: str) -> DataFrame:
    pairs = pair_with_models(order_items(spark, folder), MODELS)
    return (
        join_predictions(pairs, stored_predictions(spark, folder))
        .withColumn("prediction", clean_prediction(F.col("prediction")))
        .withColumn("exact", exact_match(F.col("prediction"), F.col("expected")))
    )


def verdict_table(spark: SparkSession, folder: str) -> DataFrame:
    """Judged statements: those of urgent orders are valid, of low ones not, others unjudged."""
    return (
        order_items(spark, folder)
        .filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW"))
        .select(F.col("expected").alias("sql"), (F.col("o_orderpriority") != "5-LOW").alias("valid"))
        .unionByName(
            table(spark, folder, "region").select(F.lit("SELECT 1").alias("sql"), F.lit(True).alias("valid"))
        )
    )


# One line per model and order: what was predicted, what was expected, is it valid.
_PAIRS = f"""WITH pairs AS (
    SELECT m.model_idx, m.name, o_orderkey AS item_id, {_SQL} AS expected, o_orderpriority,
        CASE WHEN m.model_idx = 0 AND o_orderstatus = 'F' THEN {_SQL}
             WHEN m.model_idx = 1 AND o_orderstatus = 'F' THEN {_SQL} || ';'
             WHEN m.model_idx = 1 AND o_orderstatus = 'P' THEN 'SELECT 1'
             WHEN m.model_idx = 1 THEN {_SQL} ELSE '' END AS prediction
    FROM orders, (VALUES (0, 'base/alpha'), (1, 'tuned'), (2, 'idle')) AS m(model_idx, name)
), judged AS (
    SELECT *, CASE WHEN prediction = expected THEN 1 ELSE 0 END AS exact,
        CASE WHEN prediction = 'SELECT 1' THEN 1
             WHEN prediction = expected AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS ok
    FROM pairs)"""


@query(
    f"""{_PAIRS} SELECT model_idx, name, 0.5 * (sum(exact) / count(*)) AS score, sum(exact) / count(*) AS exact_acc,
        CAST(0.0 AS DOUBLE) AS valid_acc FROM judged GROUP BY model_idx, name"""
)
def score_without_database(spark, folder):
    return score_models(scored_predictions(spark, folder), MODELS)


@query(
    f"""{_PAIRS} SELECT model_idx, name, 0.5 * (sum(exact) / count(*)) + 0.5 * (sum(ok) / count(*)) AS score,
        sum(exact) / count(*) AS exact_acc, sum(ok) / count(*) AS valid_acc FROM judged GROUP BY model_idx, name"""
)
def score_with_verdicts(spark, folder):
    return score_models(scored_predictions(spark, folder), MODELS, verdict_table(spark, folder))


@query(f"{_PAIRS} SELECT model_idx, item_id, prediction, exact, ok FROM judged")
def verdict_rows(spark, folder):
    """The verdict of every single prediction; one statement fills a ninth of the rows."""
    scored = materialize(
        scored_predictions(spark, folder).select("model_idx", "item_id", "prediction", "exact"), "scored"
    )
    judged = with_verdicts(scored, verdict_table(spark, folder))
    return judged.select("model_idx", "item_id", "prediction", "exact", F.col("valid").cast("int").alias("ok"))


@query(
    """SELECT CAST(0 AS INTEGER) AS model_idx, 'no items' AS name, CAST(count(o_orderkey) FILTER (o_orderkey < 0) AS DOUBLE) AS score FROM orders
    UNION ALL SELECT 1, 'still no items', CAST(count(o_orderkey) FILTER (o_orderkey < 0) AS DOUBLE) FROM orders"""
)
def score_empty(spark, folder):
    """No item passes the filter: every model scores 0, not null."""
    models = (ModelSpec("no items"), ModelSpec("x", "still no items"))
    none = order_items(spark, folder).filter(F.col("item_id") < 0)
    scored = pair_with_models(none, models).withColumn("prediction", F.lit("")).withColumn("exact", F.lit(1))
    return score_models(scored, models).select("model_idx", "name", "score")


_STATEMENT = """CASE o_orderpriority
    WHEN '1-URGENT' THEN 'SELECT * FROM public.orders AS o, "Lineitem" l WHERE o_orderkey = ' || o_orderkey
    WHEN '2-HIGH' THEN 'SELECT extract(year FROM o_orderdate) FROM Orders JOIN missing_' || o_custkey || ' USING (k)'
    WHEN '3-MEDIUM' THEN 'WITH few AS (SELECT * FROM orders WHERE o_custkey = ' || o_custkey || ') SELECT * FROM few, nation -- FROM nowhere'
    WHEN '4-NOT SPECIFIED' THEN 'DELETE FROM orders WHERE o_orderkey = ' || o_orderkey
    ELSE 'SELECT ''FROM nowhere'' FROM orders WHERE a IS DISTINCT FROM b' END"""


@query(
    f"""SELECT sql, bool_and(ok) AS links_ok FROM (
        SELECT {_STATEMENT} AS sql, o_orderpriority IN ('1-URGENT', '3-MEDIUM', '5-LOW') AS ok FROM orders
    ) GROUP BY sql"""
)
def link_check(spark, folder):
    """Statements made from orders against a catalog of the given tables."""
    statements = table(spark, folder, "orders").select(F.expr(_STATEMENT.replace("''", "\\'")).alias("sql"))
    names = ("orders", '"Lineitem"', "nation", "customer")
    catalog = spark.createDataFrame([(n,) for n in names], "table_name string")
    return check_links(statements, catalog)


# Statements whose scopes decide, and whether all tables they read exist.
_SCOPED = [
    ("SELECT * FROM (SELECT 1) x, missing WHERE k = %", False),
    ("SELECT * FROM orders o JOIN nation n ON o.a = n.a AND f(o.b, %) = n.b, missing", False),
    ("WITH t AS (SELECT %) SELECT * FROM public.t", False),
    ("WITH a AS (SELECT * FROM b), b AS (SELECT % FROM orders) SELECT * FROM a, b", False),
    ("SELECT * FROM (WITH t AS (SELECT %) SELECT * FROM t) x JOIN t ON true", False),
    ("SELECT extract(year FROM max((SELECT max(d) FROM orders))), % FROM nation", True),
    ("SELECT substring(lower(s) FROM 2 FOR 3), % FROM generate_series(1, 9) g, LATERAL h(g) i, customer", True),
    ("WITH RECURSIVE r AS (SELECT 1 UNION ALL SELECT n + 1 FROM r WHERE n < %) SELECT * FROM r", True),
    ("SELECT $$FROM nowhere$$, a IS NOT DISTINCT FROM b FROM (orders o CROSS JOIN (VALUES (%)) v(x)), nation", True),
    ("(SELECT % FROM orders) UNION ALL (SELECT 1 FROM customer GROUP BY a, b ORDER BY c, d)", True),
]
_SCOPED_SQL = "CASE o_orderkey % 10 " + " ".join(
    "WHEN {} THEN '{}' || o_orderkey || '{}'".format(i, *s.split("%")) for i, (s, _) in enumerate(_SCOPED)
) + " END"


@query(f"SELECT {_SCOPED_SQL} AS sql, o_orderkey % 10 >= {[ok for _, ok in _SCOPED].index(True)} AS links_ok FROM orders")
def link_scopes(spark, folder):
    """Statements of every order in which subqueries, calls and common table expressions decide."""
    statements = table(spark, folder, "orders").select(F.expr(_SCOPED_SQL).alias("sql"))
    catalog = spark.createDataFrame([("orders",), ("nation",), ("customer",)], "table_name string")
    return check_links(statements, catalog)


def stub_factory(model: ModelSpec):
    """A deterministic predictor: model identity, then facts about the prompt."""
    label = "+".join([model.base_model_path, *model.adapters])

    def predict(prompts, max_tokens):
        return [f"{label}:{len(p)}:{p.count(' ')}:{max_tokens};\nunused" for p in prompts]

    return predict


_STUB_MODELS = "(VALUES (0, 'base/alpha', 'base/alpha'), (1, 'tuned', 'base/beta+first+second'), (2, 'idle', 'base/gamma')) AS m(model_idx, name, label)"


@query(
    f"""SELECT doc_id, model_idx, name, label || ':' || length(text) || ':' || (length(text) - length(replace(text, ' ', ''))) || ':50' AS prediction
        FROM documents, {_STUB_MODELS}"""
)
def stub_generate(spark, folder):
    """Every model of the roster on every document, cut at the stop sequence."""
    items = table(spark, folder, "documents").select("doc_id", F.col("text").alias("prompt_text"))
    rows = predict_roster(items, "prompt_text", MODELS, stub_factory)
    return rows.select(
        "doc_id", "model_idx", "name", clean_prediction(F.col("prediction"), [";\n"]).alias("prediction")
    )


@query(
    """SELECT conv_id, turn, 'base/beta+first+second:' || length(text) || ':' || (length(text) - length(replace(text, ' ', ''))) || ':7;' || chr(10) || 'unused' AS completion
        FROM conversations"""
)
def generate_without_prompt(spark, folder):
    """A predictor that echoes its prompt: only the completion is kept."""

    def echoing(model: ModelSpec):
        predict = stub_factory(model)
        return lambda prompts, cap: [p + a for p, a in zip(prompts, predict(prompts, cap))]

    turns = table(spark, folder, "conversations")
    answer = generate(F.col("text"), echoing, MODELS[1], max_tokens=7, echoes_prompt=True)
    return turns.select("conv_id", "turn", answer.alias("completion"))


@query(
    f"""{_PAIRS} SELECT model_idx, name, regexp_replace(name, '[^A-Za-z0-9_-]', '_', 'g') AS model_safe, CAST(item_id AS VARCHAR) AS item_id,
        'What does order ' || item_id || ' cost?' AS question, prediction, expected, exact FROM judged"""
)
def run_log(spark, folder):
    """The run log written per model and run, and one run read back."""
    rows = scored_predictions(spark, folder)
    question = F.concat(F.lit("What does order "), F.col("item_id"), F.lit(" cost?"))
    rows = rows.withColumn("question", question).withColumn("prompt_text", F.concat(question, F.lit("\nSQL:")))
    rows = rows.withColumn("item_id", F.col("item_id").cast("string"))
    path = scratch_path(spark, "run-log")
    write_run_log(rows, "20260101_000000", path)
    return read_run_log(spark, path, "20260101_000000").select(
        "model_idx", "name", "model_safe", "item_id", "question", "prediction", "expected", "exact"
    )


_ANSWERED = """WITH items AS (
    SELECT doc_id, CASE WHEN lang = 'en' THEN 'a ' || length(text) ELSE 'b ' || length(text) END AS expected,
        'a ' || length(text) AS alpha, 'SELECT 1' AS beta FROM documents
), answers AS (
    SELECT 0 AS model_idx, 'base/alpha' AS name, alpha = expected AS exact, alpha LIKE '%0' AS ok FROM items
    UNION ALL SELECT 1, 'tuned', beta = expected, TRUE FROM items
    UNION ALL SELECT 2, 'idle', FALSE, FALSE FROM items)"""


@query(
    f"""{_ANSWERED} SELECT model_idx, name, count(*) FILTER (exact) / count(*) AS exact_acc, count(*) FILTER (ok) / count(*) AS valid_acc,
        0.5 * (count(*) FILTER (exact) / count(*)) + 0.5 * (count(*) FILTER (ok) / count(*)) AS score
        FROM answers GROUP BY model_idx, name"""
)
def evaluate_job(spark, folder):
    """The whole evaluation: items and template from files, generation, run log, verdicts, scores."""
    docs = table(spark, folder, "documents")
    size = F.length("text")
    expected = F.concat(F.when(F.col("lang") == "en", "a ").otherwise("b "), size)
    items, template = scratch_path(spark, "items"), scratch_path(spark, "template")
    docs.select(
        F.to_json(F.struct(F.col("text").alias("question"), F.col("lang").alias("schema"), expected.alias("sql")))
    ).write.text(items)
    document = {"messages": [{"role": "user", "content": "{% if schema %}in {{schema}}{% endif %}: {{question}}"}]}
    write_config(spark, document, template)
    spec = EvaluateSpec(items, template, MODELS)

    def factory(model: ModelSpec):
        def predict(prompts, max_tokens):
            if model.name == "idle":
                return [""] * len(prompts)
            if model.adapters:
                return ["SELECT 1"] * len(prompts)
            return [f" a {len(p) - len('in xx: ')}\n" for p in prompts]

        return predict

    judged = docs.select(F.concat(F.lit("a "), size).alias("sql"), (size % 10 == 0).alias("valid"))
    one = table(spark, folder, "region").select(F.lit("SELECT 1").alias("sql"), F.lit(True).alias("valid"))
    return run_evaluate(spark, spec, factory, judged.unionByName(one))
