"""Train on one table, evaluate on another, report one row per model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcast.ml.models import CLASSIFICATION, REGRESSION, fit_all, model_prediction_col
from lotcast.ml.score import score
from lotcast.operators.clean import reject_free
from lotcast.operators.metrics import (
    classification_metrics,
    leaderboard_classification,
    leaderboard_regression,
    regression_metrics,
)


def evaluate(models: Mapping[str, PipelineModel], test: DataFrame, label: str, family: str) -> DataFrame:
    """Leaderboard of fitted models on ``test``: one scoring scan, one
    metrics aggregation for all models (ids follow the models' order). Rows
    with a NULL or NaN label or feature count for no model;
    :func:`evaluated_rows` says how many those are."""
    scored = score(_labelled(test, label), models)
    preds = {name: model_prediction_col(model) for name, model in models.items()}
    if family == REGRESSION:
        return leaderboard_regression(regression_metrics(scored, label, preds))
    if family == CLASSIFICATION:
        return leaderboard_classification(classification_metrics(scored, label, preds))
    raise ValueError(f"unknown family {family!r}")


def _labelled(test: DataFrame, label: str) -> DataFrame:
    return test.where(reject_free(test, [label]))


def evaluated_rows(models: Mapping[str, PipelineModel], test: DataFrame, label: str) -> DataFrame:
    """``id``, ``algorithm_name``, ``n_rows``, ``n_scored``, ``n_skipped`` per
    model: which rows of ``test`` its leaderboard line rests on. One
    aggregation, no scoring."""
    features = {name: model.stages[0].getInputCols() for name, model in models.items()}
    counts = test.agg(F.count(F.lit(1)).alias("n"), *[
        F.count_if(reject_free(test, [*cols, label])).alias(f"s{i}")
        for i, cols in enumerate(features.values())])
    rows = [F.struct(F.lit(i + 1).alias("id"), F.lit(name).alias("algorithm_name"), F.col("n").alias("n_rows"),
                     F.col(f"s{i}").alias("n_scored"), (F.col("n") - F.col(f"s{i}")).alias("n_skipped"))
            for i, name in enumerate(features)]
    return counts.select(F.inline(F.array(*rows)))


def train_and_evaluate(train: DataFrame, test: DataFrame, features: Sequence[str], label: str,
                       family: str, prefix: str | None = None,
                       seed: int = 10, fit_partitions: int | None = None) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Fit the family's three models on ``train`` and rank them on ``test``."""
    models = fit_all(train, features, label, family, prefix=prefix, seed=seed, fit_partitions=fit_partitions)
    return models, evaluate(models, test, label, family)
