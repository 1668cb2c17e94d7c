"""Scoring predictions: exact match, statement validity, one score per model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cut_at_stop, py_strip
from ..sources.config import ModelSpec
from ..sources.roster import roster_column, roster_table
from .sizes import parts_for
from .skew import join_lookup


def pair_with_models(items: DataFrame, models: Sequence[ModelSpec]) -> DataFrame:
    """Every item once per model.

    The roster is part of the job description, so it becomes a constant array next to each item:
    a narrow step with no join.
    """
    if not models:
        raise ValueError("no models given")
    return items.withColumn("_model", F.explode(roster_column(models))).select(
        F.col("_model.model_idx").alias("model_idx"), F.col("_model.name").alias("name"), *items.columns
    )


def join_predictions(pairs: DataFrame, predictions: DataFrame, item_key: str = "item_id") -> DataFrame:
    """Bring stored predictions to their items; an item without one gets an empty prediction.

    Two predictions of a model for one item end the job: counting the item twice would be wrong.
    Both sides are dealt by the key to as many partitions as their size needs (both are read once more
    for that), so what a task sorts does not grow with the tables.
    """
    key = ["model_idx", item_key]
    parts = parts_for(pairs, predictions)
    pairs, predictions = pairs.repartition(parts, *key), predictions.repartition(parts, *key)
    stored = predictions.groupBy(*key).agg(F.count("*").alias("_n"), F.first("prediction").alias("_prediction"))
    twice = F.raise_error(F.concat(F.lit("two predictions for item "), F.col(item_key).cast("string")))
    one = F.when(F.col("_n") > 1, twice.cast("string")).otherwise(F.coalesce("_prediction", F.lit("")))
    return pairs.join(stored, key, "left").withColumn("prediction", one).drop("_n", "_prediction")


def clean_prediction(prediction: Column, stop: Sequence[str] = ()) -> Column:
    """The prediction as it is compared: null as empty, cut at a stop sequence if any, stripped."""
    return py_strip(cut_at_stop(F.coalesce(prediction, F.lit("")), stop))


def exact_match(prediction: Column, expected: Column) -> Column:
    """1 when both texts are the same to the letter, else 0."""
    return (prediction == expected).cast("int")


def _one_verdict_per_statement(verdicts: DataFrame) -> DataFrame:
    return verdicts.groupBy("sql").agg(F.bool_and("valid").alias("valid"))


def with_verdicts(rows: DataFrame, verdicts: DataFrame | None, statement: str = "prediction") -> DataFrame:
    """Row by row: is the statement valid?  Empty or unjudged statements are not.

    ``verdicts(sql, valid)`` comes from any checker.  Without one, nothing counts as valid.
    """
    if verdicts is None:
        return rows.withColumn("valid", F.lit(False))
    lookup = _one_verdict_per_statement(verdicts).withColumnRenamed("sql", statement)
    return join_lookup(rows, lookup, statement).withColumn(
        "valid", F.coalesce(F.col("valid") & (F.col(statement) != ""), F.lit(False))
    )


def score_models(
    scored: DataFrame,
    models: Sequence[ModelSpec],
    verdicts: DataFrame | None = None,
    weights: tuple[float, float] = (0.5, 0.5),
) -> DataFrame:
    """One row per model in roster order: name, combined score, exact and validity rates.

    ``scored`` has ``model_idx, prediction, exact``.  Rows are first reduced to distinct
    statements per model, so a statement that fills a third of the rows is looked up once.  A
    model with no items scores 0.
    """
    if verdicts is None:
        counted = scored.groupBy("model_idx").agg(
            F.count("*").alias("n"), F.sum("exact").alias("n_exact"), F.lit(0).alias("n_valid")
        )
    else:
        statements = scored.groupBy("model_idx", "prediction").agg(
            F.count("*").alias("n"), F.sum("exact").alias("n_exact")
        )
        lookup = _one_verdict_per_statement(verdicts).withColumnRenamed("sql", "prediction")
        is_valid = F.coalesce(F.col("valid") & (F.col("prediction") != ""), F.lit(False))
        counted = (
            statements.join(lookup, "prediction", "left")
            .groupBy("model_idx")
            .agg(
                F.sum("n").alias("n"),
                F.sum("n_exact").alias("n_exact"),
                F.sum(F.when(is_valid, F.col("n")).otherwise(0)).alias("n_valid"),
            )
        )
    items = F.greatest(F.coalesce("n", F.lit(0)), F.lit(1))
    rates = (
        roster_table(scored.sparkSession, models)
        .select("model_idx", "name")
        .join(counted, "model_idx", "left")
        .select(
            "model_idx",
            "name",
            (F.coalesce("n_exact", F.lit(0)) / items).alias("exact_acc"),
            (F.coalesce("n_valid", F.lit(0)) / items).alias("valid_acc"),
        )
    )
    combined = weights[0] * F.col("exact_acc") + weights[1] * F.col("valid_acc")
    return rates.select("model_idx", "name", combined.alias("score"), "exact_acc", "valid_acc").orderBy(
        "model_idx"
    )
