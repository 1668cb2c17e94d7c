from __future__ import annotations

import json
import os
import uuid

import pytest
import yaml
from pyspark.sql import functions as F

from promptmill.functions.chat import ChatFormat
from promptmill.operators.predict import predict_roster
from promptmill.operators.scoring import join_predictions
from promptmill.operators.templates import Template
from promptmill.operators.tokens import hashed_ids
from promptmill.plans.evaluate import run_evaluate
from promptmill.plans.render import run_render
from promptmill.plans.train_data import run_train_data
from promptmill.sinks.writers import RUN_LOG_COLUMNS, read_run_log, write_run_log
from promptmill.session import materialize, scratch_path, shared_dir
from promptmill.sources.chat import parse_chat
from promptmill.sources.config import EvaluateSpec, InferenceSpec, ModelSpec, RenderSpec, TrainingSpec, load_yaml
from promptmill.streaming.streams import answer_requests, answer_stream, chat_file_stream, ingest_stream
from test_templates import INFERENCE, SQL_ONLY, TEXT_OR_SQL


def _lines(path):
    return [
        line for part in sorted(path.glob("part-*")) for line in part.read_text().split("\n") if line
    ]


@pytest.fixture
def job(tmp_path):
    (tmp_path / "sql.json").write_text(json.dumps(SQL_ONLY))
    (tmp_path / "both.json").write_text(json.dumps(TEXT_OR_SQL))
    (tmp_path / "ask.json").write_text(json.dumps(INFERENCE))
    records = [{"question": f"q{i}", "POSTGRESQL_QUERY": f"select {i}", "SCHEMA_JSON": "t" * (i % 2)} for i in range(9)]
    (tmp_path / "list.json").write_text(json.dumps(records))
    (tmp_path / "lines.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records))
    return tmp_path


def test_render_job(spark, job):
    config = {
        "default_template": str(job / "sql.json"),
        "datasets": [
            {"input": str(job / "list.json"), "output": str(job / "out/a/one")},
            {"input": str(job / "lines.jsonl"), "output": str(job / "out/two"), "template": str(job / "both.json")},
        ],
    }
    (job / "job.yaml").write_text(yaml.safe_dump(config))
    spec = RenderSpec.of(load_yaml(str(job / "job.yaml")))
    run_render(spark, spec, mode="raw", ordered=True)
    one = [json.loads(x)["messages"] for x in _lines(job / "out/a/one")]
    assert [m[2]["content"] for m in one] == [f"Cook select {i}." for i in range(9)]
    assert [m[1]["content"] for m in one][:2] == ["Dish q0, please", "Dish q1 from [t], please"]
    run_render(spark, spec, mode="safe")
    two = [json.loads(x)["messages"] for x in _lines(job / "out/two")]
    assert sorted(m[-1]["content"] for m in two) == [f"select {i}" for i in range(9)]
    with pytest.raises(TypeError):
        RenderSpec.of({"default_template": "x", "datasets": [{"input": "a", "output": "b", "other": 1}]})
    with pytest.raises(KeyError):
        RenderSpec.of({"datasets": []})
    assert RenderSpec.of({"default_template": "x"}).datasets == ()


def test_train_data_job(spark, tmp_path):
    one, two = tmp_path / "one.jsonl", tmp_path / "two.jsonl"
    one.write_text("".join(json.dumps({"messages": [{"role": "user", "content": "w " * (i % 5)}]}) + "\n" for i in range(23)))
    two.write_text('{bad\n[{"role":"user","content":"bare list"}]\n7\n')
    given = {
        "model": {"base_model_path": "x"},
        "training": {
            "datasets": [str(one), str(two)], "output_dir": str(tmp_path / "out"), "batch_size": 4,
            "gradient_accumulation_steps": 2, "num_epochs": 2, "learning_rate": "4e-4",
        },
    }
    batches = run_train_data(
        spark, TrainingSpec.of(given), lambda t: hashed_ids(t, 1000, 10), pad_id=0, max_length=3, shard_tokens=16
    )
    rows = batches.collect()
    assert len(rows) == 48
    assert sorted(r.row_index for r in rows if r.epoch == 0) == list(range(24))
    for r in rows:
        assert r.batch_id == r.row_index // 4 and r.step_id == r.batch_id // 2 and r.device == 0
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == r.batch_length <= 3
        assert sum(r.attention_mask) == r.n_tokens == sum(x != -100 for x in r.labels)
        same = [s.n_tokens for s in rows if (s.epoch, s.batch_id) == (r.epoch, r.batch_id)]
        assert r.batch_length == max(same)
    counts = {(r.src_idx, r.what): r.n for r in spark.read.parquet(str(tmp_path / "out/counts")).collect()}
    assert counts[1, "malformed"] == counts[1, "non_object"] == counts[1, "kept"] == 1
    assert spark.read.parquet(str(tmp_path / "out/prompts")).filter("prompt_text = 'bare list'").count() == 1
    assert json.loads(spark.read.text(str(tmp_path / "out/config")).first()[0]) == given
    padded = run_train_data(
        spark,
        TrainingSpec.of({"training": {**given["training"], "pad_to_max_length": True, "num_epochs": 1}}),
        lambda t: hashed_ids(t, 1000, 10), pad_id=0, max_length=5,
    )
    assert {len(r.input_ids) for r in padded.collect()} == {5}


def test_seeded_order_depends_on_the_lines_only(spark, tmp_path):
    orders = []
    for folder, split in (("first place", "64"), ("second", "134217728")):
        source = tmp_path / folder / "data"
        source.mkdir(parents=True)
        for name in ("a.jsonl", "b.jsonl"):
            said = [json.dumps({"messages": [{"role": "user", "content": f"{name} {i}"}]}) for i in range(40)]
            (source / name).write_text("\n".join(["", *said[:20], "{bad", *said[20:]]) + "\n")
        spec = TrainingSpec((str(source),), str(tmp_path / folder / "out"), batch_size=4, seed=3)
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            batches = run_train_data(spark, spec, lambda t: hashed_ids(t, 1000, 10), pad_id=0)
            orders.append(sorted((r.row_index, r.src_path, r.line_no) for r in batches.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        rejects = spark.read.parquet(str(tmp_path / folder / "out/rejects")).collect()
        assert [(r.line_no, r.reason, r.line) for r in rejects] == [(22, "malformed", "{bad")] * 2
    assert orders[0] == orders[1] and len(orders[0]) == 80
    assert {path for _, path, _ in orders[0]} == {"a.jsonl", "b.jsonl"}


def test_models_load_once_per_worker(spark, tmp_path):
    def factory(model):
        (tmp_path / f"{os.getpid()}-{uuid.uuid4().hex}").touch()
        return lambda prompts, cap: list(prompts)

    items = spark.range(200).repartition(50).select(F.col("id").cast("string").alias("p"))
    roster = [ModelSpec("m")]
    assert predict_roster(items, "p", roster, factory).filter("p = prediction").count() == 200
    loads = [p.name.split("-")[0] for p in tmp_path.iterdir()]
    assert len(loads) == len(set(loads))


def test_repeated_run_forgets_models_that_left_the_roster(spark, tmp_path):
    kinds = {"model_idx": "int", "exact": "int"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in RUN_LOG_COLUMNS)

    def rows(*answers):
        values = [(k, name, "1", "q", "p", a, "x", int(a == "x")) for k, (name, a) in enumerate(answers)]
        return spark.createDataFrame(values, schema)

    path = str(tmp_path / "log")
    write_run_log(rows(("bad", "y"), ("good", "x")), "r 1", path)
    write_run_log(rows(("other", "y")), "r2", path)
    write_run_log(rows(("good", "x")), "r 1", path)
    assert [(r.name, r.exact) for r in read_run_log(spark, path, "r 1").collect()] == [("good", 1)]
    assert read_run_log(spark, path, "r2").count() == 1


def test_two_predictions_for_an_item_are_refused(spark):
    pairs = spark.createDataFrame([(0, "a")], "model_idx int, item_id string")
    twice = spark.createDataFrame([(0, "a", "x"), (0, "a", "y")], "model_idx int, item_id string, prediction string")
    assert join_predictions(pairs, twice.limit(1)).first().prediction == "x"
    with pytest.raises(Exception, match="two predictions"):
        join_predictions(pairs, twice).collect()


MODELS = [{"base_model_path": "m/one"}, {"name": "two", "base_model_path": "m/two", "adapters": ["a"]}]


def _answering(answers):
    def factory(model):
        if model.adapters:
            return lambda prompts, cap: ["nonsense"] * len(prompts)
        return lambda prompts, cap: [answers.get(p, "") + " \n" for p in prompts]

    return factory


@pytest.mark.parametrize("mode", ["safe", "raw"])
def test_evaluate_job(spark, job, mode):
    items = [{"question": f"q{i}", "sql": f"select {i}"} for i in range(6)]
    (job / "items.json").write_text("\n".join(json.dumps(i) for i in items))
    prompts = {f"Recipes.\nq{i} =>": f"select {i};\nmore" for i in range(4)}
    spec = EvaluateSpec.of({"models": MODELS, "data_path": str(job / "items.json"), "prompt_template": str(job / "ask.json")})
    verdicts = spark.createDataFrame([("select 1", True), ("nonsense", False)], "sql string, valid boolean")
    log = str(job / "log")
    rows = run_evaluate(spark, spec, _answering(prompts), verdicts, stop=[";\n"], mode=mode, log_path=log, run_id="r1").collect()
    assert [(r.name, round(r.exact_acc * 6), round(r.valid_acc * 6)) for r in rows] == [("m/one", 4, 1), ("two", 0, 0)]
    assert rows[0].score == 0.5 * rows[0].exact_acc + 0.5 * rows[0].valid_acc
    # Without stop sequences the trailing semicolon spoils every match.
    rows = run_evaluate(spark, spec, _answering(prompts), mode=mode, log_path=log, run_id="r2").collect()
    assert [r.score for r in rows] == [0.0, 0.0]
    # The same run again replaces its own rows and no others.
    run_evaluate(spark, spec, _answering(prompts), verdicts, stop=[";\n"], mode=mode, log_path=log, run_id="r1")
    logged = spark.read.parquet(log)
    assert logged.count() == 24 and {r.model_safe for r in logged.select("model_safe").collect()} == {"m_one", "two"}
    assert logged.filter("run_id = 'r1' and question = 'q1' and name = 'm/one'").first().prediction == "select 1"


def test_evaluate_without_models_or_settings(spark, job):
    (job / "items.json").write_text("")
    base = {"data_path": str(job / "items.json"), "prompt_template": str(job / "ask.json")}
    assert run_evaluate(spark, EvaluateSpec.of(base), _answering({})).collect() == []
    rows = run_evaluate(spark, EvaluateSpec.of({**base, "models": MODELS}), _answering({})).collect()
    assert [r.score for r in rows] == [0.0, 0.0]
    for missing in base:
        with pytest.raises(ValueError):
            EvaluateSpec.of({k: v for k, v in base.items() if k != missing})


def test_request_stream_equals_batch(spark, tmp_path):
    requests = tmp_path / "in"
    requests.mkdir()
    for n in range(3):
        (requests / f"{n}.json").write_text(json.dumps({"question": f"  q{n}\t", "schema": "s" * n}) + "\n")
    spec = InferenceSpec.of({"model": MODELS[1], "prompt_template": "-", "stop": ["```", ";\n"]})
    schema = "question string, schema string"

    def factory(model):
        return lambda prompts, cap: [f"{p.upper()};\nrest```" for p in prompts]

    def answered(df):
        return answer_requests(df, Template(INFERENCE), spec, factory, ChatFormat(generation="!"), halt=True)

    batch = answered(spark.read.schema(schema).json(str(requests)))
    query = answer_stream(
        answered(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(requests))),
        str(tmp_path / "out"), str(tmp_path / "check"),
    ).trigger(availableNow=True).start()
    query.awaitTermination(120)
    streamed = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))
    row = batch.filter("schema = ''").first()
    assert row.prompt_text == "systemRecipes.userq0 =>!"
    assert row.response == "SYSTEMRECIPES.USERQ0 =>!"


def test_chat_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in range(3):
        (folder / f"{n}.jsonl").write_text(f'[{{"role":"u","content":"{n}"}}]\n\n{{bad\n{n}\n{{"messages":[1]}}\n')
    query = ingest_stream(
        chat_file_stream(spark, str(folder), 1), str(tmp_path / "out"), str(tmp_path / "check")
    ).trigger(availableNow=True).start()
    query.awaitTermination(120)
    columns = ["status", "reason", "messages", "no_messages", "n_invalid", "line"]
    streamed = spark.read.parquet(str(tmp_path / "out")).select(*columns)
    batch = parse_chat(spark.read.text(str(folder))).select(*columns)
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))
    assert streamed.filter("status = 'rejected'").count() == 6


def test_materialize_uses_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    df = materialize(spark.range(5).select("id", F.parse_json(F.lit('{"a":1}')).alias("v")), "t")
    assert df.count() == 5 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_model_spec():
    assert ModelSpec.of({"base_model_path": "p", "adapters": None}).display_name == "p"


def _counts(path):
    return {p["what"]: p["n"] for part in path.glob("**/part-*") for p in map(json.loads, part.read_text().split("\n")[:-1])}


def test_render_job_counts_and_sorts_out(spark, job):
    records = [{"question": 'a "quoted" one' if i % 4 == 0 else f"q{i}", "sql": "s"} for i in range(12)]
    (job / "some.jsonl").write_text("".join(json.dumps(r) + "\n" for r in records))
    dataset = {"input": str(job / "some.jsonl"), "output": str(job / "out")}
    spec = RenderSpec.of({"default_template": str(job / "sql.json"), "datasets": [dataset]})
    expected = {"rendered": 12, "invalid": 3}
    assert run_render(spark, spec, mode="raw") == [expected] and len(_lines(job / "out")) == 12
    assert run_render(spark, spec, mode="raw", on_error="quarantine") == [expected]
    assert _counts(job / "out.counts") == expected
    assert len(_lines(job / "out/status=good")) == 9 and len(_lines(job / "out/status=bad")) == 3
    assert run_render(spark, spec, on_error="fail") == [{"rendered": 12, "invalid": 0}]
    with pytest.raises(Exception, match="no JSON"):
        run_render(spark, spec, mode="raw", on_error="fail")
    with pytest.raises(ValueError):
        run_render(spark, spec, on_error="drop")


def test_evaluate_job_names_items_by_place_and_sorts_out(spark, job):
    records = [{"question": '"broken' if i == 3 else f"q{i}", "sql": "select 1"} for i in range(40)]
    ids = []
    for folder, split in (("here", "200"), ("some where", "134217728")):
        (job / folder / "data").mkdir(parents=True)
        lines = [json.dumps(r) for r in records]
        (job / folder / "data" / "a.jsonl").write_text("\n".join([*lines[:2], "", *lines[2:]]) + "\n")
        (job / folder / "data" / "b.json").write_text(json.dumps(records[4:20]))
        given = {"models": MODELS, "data_path": str(job / folder / "data"), "prompt_template": str(job / "ask.json")}
        log = job / folder / "log"
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        try:
            run_evaluate(spark, EvaluateSpec.of(given), _answering({}), mode="raw", log_path=str(log), run_id="r", on_error="quarantine")
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        logged = spark.read.parquet(str(log)).filter("name = 'two'")
        ids.append({(r.item_id, r.question) for r in logged.select("item_id", "question").collect()})
        rejects = spark.read.parquet(str(job / folder / "log.rejects/run_id=r")).collect()
        assert [r.item_id for r in rejects] == ["0:a.jsonl:4"] and '"broken' in rejects[0].rendered
        assert _counts(job / folder / "log.counts") == {"items": 56, "rejects": 1, "answers": 110, "exact": 0}
    assert ids[0] == ids[1] and len(ids[0]) == 55
    assert {i for i, q in ids[0] if q == "q10"} == {"0:a.jsonl:11", "0:b.json:7"}
