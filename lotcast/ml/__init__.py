"""spark.ml layer: fitting, persistence, one-pass scoring, leaderboards."""

from lotcast.ml.models import (
    CLASSIFICATION,
    REGRESSION,
    assembler,
    fit_all,
    load_all,
    model_prediction_col,
    prediction_col,
    save_all,
    usable,
)
from lotcast.ml.bagging import fit_bagged
from lotcast.ml.least_squares import GrowingFit
from lotcast.ml.score import score
from lotcast.ml.registry import Registry, Release
from lotcast.ml.leaderboard import evaluate, evaluated_rows, train_and_evaluate

__all__ = [
    "CLASSIFICATION", "REGRESSION", "GrowingFit", "assembler", "fit_all", "fit_bagged", "load_all", "model_prediction_col", "prediction_col",
    "Registry", "Release", "save_all", "usable", "score", "evaluate", "evaluated_rows", "train_and_evaluate",
]
