"""Model metrics as plain aggregations: every metric of every model in one
pass over the scored rows (the reference ran one Spark job per metric)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _models(predictions: str | Column | Mapping[str, str | Column]) -> list[tuple[str, Column]]:
    if isinstance(predictions, Mapping):
        return [(name, _col(p)) for name, p in predictions.items()]
    return [("model", _col(predictions))]


def regression_metrics(df: DataFrame, label: str | Column,
                       predictions: str | Column | Mapping[str, str | Column]) -> DataFrame:
    """rmse, mse, r2, mae per model: one row per model, one job in all.

    Rows where the label or that model's prediction is NULL are left out
    of that model's metrics. r2 is ``1 - mse / var_pop(label)``, which is
    the evaluator's formula without the cancellation that raw sums of
    squares suffer at large label means.
    """
    y = _col(label).cast("double")
    models = _models(predictions)
    aggs = []
    for i, (_, p) in enumerate(models):
        p = p.cast("double")
        ok = y.isNotNull() & p.isNotNull()
        err = F.when(ok, p - y)
        aggs += [
            F.avg(err * err).alias(f"_mse{i}"),
            F.avg(F.abs(err)).alias(f"_mae{i}"),
            F.var_pop(F.when(ok, y)).alias(f"_var{i}"),
        ]
    wide = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(i + 1).alias("id"),
            F.lit(name).alias("algorithm_name"),
            F.sqrt(F.col(f"_mse{i}")).alias("rmse"),
            F.col(f"_mse{i}").alias("mse"),
            (F.lit(1.0) - F.try_divide(F.col(f"_mse{i}"), F.col(f"_var{i}"))).alias("r2"),
            F.col(f"_mae{i}").alias("mae"),
        )
        for i, (name, _) in enumerate(models)
    ]
    return wide.select(F.explode(F.array(*rows)).alias("_m")).select("_m.*")


def confusion(df: DataFrame, label: str | Column,
              predictions: str | Column | Mapping[str, str | Column]) -> DataFrame:
    """(model_id, algorithm_name, label, prediction, n) cells for all models.

    The prediction columns are unpivoted into rows before the group-by so
    that one scan and one (tiny) shuffle serve every model.
    """
    y = _col(label).cast("double")
    models = _models(predictions)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(i + 1).alias("model_id"), F.lit(name).alias("algorithm_name"),
                 p.cast("double").alias("prediction"))
        for i, (name, p) in enumerate(models)
    ])).alias("_p")
    return (df.select(y.alias("label"), pairs)
            .select("_p.model_id", "_p.algorithm_name", "label", "_p.prediction")
            .where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
            .groupBy("model_id", "algorithm_name", "label", "prediction")
            .agg(F.count(F.lit(1)).alias("n")))


def class_totals(df: DataFrame, label: str | Column,
                 predictions: str | Column | Mapping[str, str | Column]) -> DataFrame:
    """Per model and class: rows truly in the class (``n_label``), rows
    predicted as it (``n_pred``) and rows both (``tp``), in one
    aggregation.

    Each scored row is emitted twice per model -- once under its true
    class, once under its predicted class -- and summed with a map-side
    partial step, so the shuffle carries one row per class per task
    whatever the data size, and no join is needed.
    """
    y = _col(label).cast("double")
    models = _models(predictions)
    sides = []
    for i, (name, p) in enumerate(models):
        p = p.cast("double")
        ok = y.isNotNull() & p.isNotNull()
        hit = F.when(y == p, F.lit(1)).otherwise(F.lit(0))
        for cls, is_true, is_pred, tp in ((y, 1, 0, hit), (p, 0, 1, F.lit(0))):
            sides.append(F.when(ok, F.struct(
                F.lit(i + 1).alias("model_id"), F.lit(name).alias("algorithm_name"),
                cls.alias("label"), F.lit(is_true).alias("t"), F.lit(is_pred).alias("q"),
                tp.alias("tp"))))
    exploded = df.select(F.explode(F.array(*sides)).alias("_s")).where(F.col("_s").isNotNull())
    return (exploded.select("_s.*")
            .groupBy("model_id", "algorithm_name", "label")
            .agg(F.sum("t").cast("long").alias("n_label"),
                 F.sum("q").cast("long").alias("n_pred"),
                 F.sum("tp").cast("long").alias("tp")))


def classification_metrics(df: DataFrame, label: str | Column,
                           predictions: str | Column | Mapping[str, str | Column]) -> DataFrame:
    """accuracy, weighted recall and weighted F1 per model.

    Same definitions as Spark's multiclass evaluator: per true class
    ``F1 = 2 tp / (n_true + n_predicted)`` (0 for a class never
    predicted), weighted by the class's share of rows. Weighted recall
    always equals accuracy; it is reported because the leaderboard
    carries it. Two aggregations over one scan, no join, no window.
    """
    f1_term = F.when(F.col("tp") > 0,
                     2.0 * F.col("tp") / (F.col("n_label") + F.col("n_pred")) * F.col("n_label"))
    return (class_totals(df, label, predictions)
            .groupBy("model_id", "algorithm_name")
            .agg(F.sum("n_label").alias("_n"),
                 F.sum("tp").alias("_tp"),
                 F.sum(f1_term).alias("_f1"))
            .select(F.col("model_id").alias("id"), "algorithm_name",
                    (F.col("_tp") / F.col("_n")).alias("accuracy"),
                    (F.col("_tp") / F.col("_n")).alias("weighted_recall"),
                    (F.coalesce(F.col("_f1"), F.lit(0.0)) / F.col("_n")).alias("f1")))


def per_class_recall(df: DataFrame, label: str | Column,
                     predictions: str | Column | Mapping[str, str | Column]) -> DataFrame:
    """Recall of each true class per model (the evaluator's weighted
    recall hides it)."""
    return (class_totals(df, label, predictions)
            .where(F.col("n_label") > 0)
            .select("model_id", "algorithm_name", "label", "n_label", "tp",
                    (F.col("tp") / F.col("n_label")).alias("recall")))


def leaderboard_regression(metrics: DataFrame) -> DataFrame:
    """Regression metrics in the price leaderboard's column layout."""
    return metrics.select(F.col("id").cast("int"), "algorithm_name", "rmse", "mse", "r2", "mae")


def leaderboard_classification(metrics: DataFrame) -> DataFrame:
    """Classification metrics in the sold leaderboard's column layout,
    each value under its own header."""
    return metrics.select(F.col("id").cast("int"), "algorithm_name",
                          F.col("accuracy").alias("accurate_rate"),
                          F.col("weighted_recall").alias("recall_rate"),
                          F.col("f1").alias("f1_score"))
