from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from promptmill.operators import scoring as sc
from promptmill.operators.links import check_links, table_names
from promptmill.operators.predict import generate, predict_roster
from promptmill.operators.skew import join_lookup
from promptmill.sources.config import ModelSpec
from promptmill.sources.roster import roster_table

MODELS = (ModelSpec("base/one"), ModelSpec("base/two", "twin", ("ad1", "ad2")), ModelSpec("base/three", "twin"))


def test_roster(spark):
    rows = [tuple(r) for r in roster_table(spark, MODELS).orderBy("model_idx").collect()]
    assert rows == [
        (0, "base/one", "base/one", []),
        (1, "twin", "base/two", ["ad1", "ad2"]),
        (2, "twin", "base/three", []),
    ]


def test_scores(spark):
    items = spark.createDataFrame([(i, f"select {i}") for i in range(4)], "item_id long, expected string")
    pairs = sc.pair_with_models(items, MODELS)
    assert pairs.count() == 12
    stored = [(0, i, f" select {i}\n") for i in range(4)] + [(1, 0, "select 0"), (1, 1, "select 0"), (1, 2, None)]
    predictions = spark.createDataFrame(stored, "model_idx int, item_id long, prediction string")
    scored = (
        sc.join_predictions(pairs, predictions)
        .withColumn("prediction", sc.clean_prediction(F.col("prediction")))
        .withColumn("exact", sc.exact_match(F.col("prediction"), F.col("expected")))
    )
    verdicts = spark.createDataFrame(
        [("select 0", True), ("select 1", False), ("select 2", True), ("", True)], "sql string, valid boolean"
    )
    rows = sc.score_models(scored, MODELS, verdicts).collect()
    assert [tuple(r) for r in rows] == [
        (0, "base/one", 0.75, 1.0, 0.5),
        (1, "twin", 0.375, 0.25, 0.5),
        (2, "twin", 0.0, 0.0, 0.0),
    ]
    unjudged = sc.score_models(scored, MODELS, weights=(1.0, 0.0)).collect()
    assert [(r.score, r.valid_acc) for r in unjudged] == [(1.0, 0.0), (0.25, 0.0), (0.0, 0.0)]
    by_row = sc.with_verdicts(scored, verdicts).groupBy("model_idx").agg(F.sum(F.col("valid").cast("int")))
    assert dict(by_row.collect()) == {0: 2, 1: 2, 2: 0}
    assert sc.with_verdicts(scored, None).filter("valid").count() == 0


def test_no_items_score_zero(spark):
    empty = spark.createDataFrame([], "model_idx int, prediction string, exact int")
    assert [tuple(r)[2:] for r in sc.score_models(empty, MODELS).collect()] == [(0.0, 0.0, 0.0)] * 3


def test_two_empty_texts_match_and_case_matters(spark):
    df = spark.createDataFrame([("", ""), ("a", "A"), ("a;", "a"), ("a", "a")], "p string, e string")
    assert [r[0] for r in df.select(sc.exact_match(F.col("p"), F.col("e"))).collect()] == [1, 0, 0, 1]


def test_join_lookup_equals_a_left_join(spark):
    rows = [(i, "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{i}")) for i in range(2000)]
    left = spark.createDataFrame(rows, "i int, k string")
    lookup = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("absent", 4)], "k string, v int")
    got = sorted(tuple(r) for r in join_lookup(left, lookup, "k").select("i", "v").collect())
    assert got == sorted(tuple(r) for r in left.join(lookup, "k", "left").select("i", "v").collect())


def _shouting():
    def factory(model):
        loaded = f"{model.base_model_path}+{'+'.join(model.adapters)}"
        return lambda prompts, max_tokens: [f"{loaded}:{p.upper()[:max_tokens]}" for p in prompts]

    return factory


def test_predict_roster(spark):
    items = spark.createDataFrame([(i, f"p{i}") for i in range(10)], "item_id long, prompt string").repartition(3)
    rows = predict_roster(items, "prompt", MODELS, _shouting(), max_tokens=2, batch_rows=2).collect()
    assert len(rows) == 30
    assert {(r.model_idx, r.prediction) for r in rows if r.item_id == 3} == {
        (0, "base/one+:P3"),
        (1, "base/two+ad1+ad2:P3"),
        (2, "base/three+:P3"),
    }
    with pytest.raises(ValueError):
        predict_roster(items, "prompt", [], _shouting())


def test_generate_takes_off_an_echoed_prompt_and_counts_answers(spark):
    items = spark.createDataFrame([("ask:",), ("x",)], "p string")
    echo = lambda model: lambda prompts, cap: [p + "yes" if p == "ask:" else "no" for p in prompts]
    got = items.select(generate(F.col("p"), echo, MODELS[0], echoes_prompt=True)).collect()
    assert [r[0] for r in got] == ["yes", "no"]
    short = lambda model: lambda prompts, cap: []
    with pytest.raises(Exception, match="answers"):
        items.select(generate(F.col("p"), short, MODELS[0])).collect()


NAMES = [
    ("SELECT COUNT(*) FROM orders", {"orders"}),
    ('select a from public."Big Table" t join Other o on t.x = o.x', {"Big Table", "other"}),
    ("select * from a, b c, d as e where x in (select y from f)", {"a", "b", "d", "f"}),
    ("with w as (select 1 from t1), v(x) as materialized (select 2 from w) select * from w, v join t2 on true", {"t1", "t2"}),
    ("select extract(year from d), substring(s from 2), trim(both 'x' from y) from t", {"t"}),
    ("select 1 from t where a is distinct from b and c is not distinct from d", {"t"}),
    ("select 'from fake' -- from c1\n /* from c2 */ from real1", {"real1"}),
    ("select 'it''s from x' from real2", {"real2"}),
    ("select * from generate_series(1, 3)", set()),
    ("select 1", set()),
    ("select * from (select * from inner_t) q left join lateral_t on true", {"inner_t", "lateral_t"}),
    ("delete from t", {"t"}),
]


def test_table_names(spark):
    df = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(NAMES)], "i int, sql string")
    got = df.select("i", table_names(F.col("sql"))).orderBy("i").collect()
    for (sql, names), row in zip(NAMES, got):
        assert set(row[1]) == names, sql


def test_check_links(spark):
    statements = spark.createDataFrame(
        [("select 1 from orders",), ("select 1 from orders",), ("SELECT x FROM nope",), ("delete from orders",),
         ("select 1",), (None,), ("with a as (select * from orders) select * from a, public.nation",), ("oops",)],
        "sql string",
    )
    catalog = spark.createDataFrame([("orders",), ("nation",), ("orders",)], "table_name string")
    got = dict(check_links(statements, catalog).collect())
    assert got == dict(check_links(statements, catalog, max_sent=1).collect())
    assert got == {
        "select 1 from orders": True,
        "SELECT x FROM nope": False,
        "delete from orders": False,
        "select 1": True,
        "": False,
        "with a as (select * from orders) select * from a, public.nation": True,
        "oops": False,
    }
