"""Batch generation with a user's predictor."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from uuid import uuid4

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variants import let
from ..functions.worker import once_per_worker
from ..sources.config import ModelSpec

# Prompts and a cap on generated tokens in, completions out.
Predictor = Callable[[Sequence[str], int], Sequence[str]]
PredictorFactory = Callable[[ModelSpec], Predictor]

DEFAULT_MAX_TOKENS = 50


def generate(
    prompt: Column,
    factory: PredictorFactory,
    model: ModelSpec,
    max_tokens: int = DEFAULT_MAX_TOKENS,
    batch_rows: int = 64,
    echoes_prompt: bool = False,
) -> Column:
    """Completions for a prompt column.

    The factory runs once per worker process and gets the model's base path and ordered adapters; the
    predictor then sees at most ``batch_rows`` prompts at a time.  Only the prompt column goes to
    Python.  The call is marked nondeterministic, so the optimizer neither repeats nor moves it.
    With ``echoes_prompt`` a leading copy of the prompt is taken off the answer.
    """

    loaded = uuid4().hex

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        predictor = once_per_worker(("predictor", loaded), lambda: factory(model))
        for prompts in batches:
            texts = prompts.tolist()
            answers: list[str] = []
            for at in range(0, len(texts), batch_rows):
                answers.extend(predictor(texts[at : at + batch_rows], max_tokens))
            if len(answers) != len(texts):
                raise ValueError(f"{len(texts)} prompts gave {len(answers)} answers")
            yield pd.Series(answers, dtype=object)

    answer = F.pandas_udf(run, "string").asNondeterministic()(prompt)
    if not echoes_prompt:
        return answer
    return let(
        answer,
        lambda a: F.when(F.startswith(a, prompt), a.substr(F.length(prompt) + 1, F.length(a))).otherwise(a),
    )


def predict_roster(
    items: DataFrame,
    prompt: str,
    models: Sequence[ModelSpec],
    factory: PredictorFactory,
    max_tokens: int = DEFAULT_MAX_TOKENS,
    batch_rows: int = 64,
) -> DataFrame:
    """Every model on every item: ``items`` plus ``model_idx, name, prediction``.

    One plan per model, each over all partitions of the items, so parallelism does not depend on
    how many models there are.  A worker keeps each model it has loaded.
    """
    if not models:
        raise ValueError("no models given")
    runs = [
        items.select(
            F.lit(i).alias("model_idx"),
            F.lit(m.display_name).alias("name"),
            *items.columns,
            generate(F.col(prompt), factory, m, max_tokens, batch_rows).alias("prediction"),
        )
        for i, m in enumerate(models)
    ]
    return reduce(DataFrame.unionByName, runs)
