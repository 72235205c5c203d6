"""One-pass scoring: every model over one scan, one output column each."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcast.ml.models import model_prediction_col
from lotcast.operators.clean import reject_free


def score(df: DataFrame, models: Mapping[str, PipelineModel], replace_label: str | None = None,
          keep_vectors: bool = False) -> DataFrame:
    """Add every model's prediction column (``<name>_prediction`` for the
    models ``fit_all`` returns); the row count is unchanged.

    The reference loaded and applied one model per scan of the input.
    Here all transforms are chained into one plan, so the input is read
    once; models that share an assembler share its vector column. A row
    with a NULL or NaN feature is not dropped: its predictions are NULL
    (the assembler is switched to ``keep`` so nothing fails or vanishes).

    ``replace_label`` gives the reference's output shape for a single
    model: the true label column is dropped and the prediction takes its
    name as the last column. Works on streaming DataFrames too.
    """
    if replace_label is not None and len(models) != 1:
        raise ValueError("replace_label needs exactly one model")
    base_cols = list(df.columns)
    out = df
    added: list[str] = []
    valid: dict[str, str] = {}
    assembled: dict[str, tuple] = {}
    for name, model in models.items():
        asm, rest = model.stages[0], model.stages[1:]
        if not isinstance(asm, VectorAssembler):
            raise ValueError(f"{name}: first stage must be the feature assembler")
        fcol = asm.getOutputCol()
        inputs = tuple(asm.getInputCols())
        if fcol in assembled and assembled[fcol] != inputs:
            raise ValueError(f"{name}: vector column {fcol!r} is built from other features by another model")
        if fcol not in out.columns:
            keep = asm.copy().setHandleInvalid("keep")
            out = keep.transform(out)
            added.append(fcol)
            assembled[fcol] = inputs
        elif fcol not in assembled:
            raise ValueError(f"{name}: input already has a column named {fcol!r}")
        if fcol not in valid:  # one boolean a vector, shared by its models
            valid[fcol] = f"{fcol}_usable"
            out = out.withColumn(valid[fcol], reject_free(df, asm.getInputCols()))
        for stage in rest:
            out = stage.transform(out)
        for col in out.columns:
            if col not in base_cols and col not in added and col not in valid.values():
                added.append(col)
    preds = []
    for model in models.values():
        fcol = model.stages[0].getOutputCol()
        p = model_prediction_col(model)
        preds.append(F.when(F.col(valid[fcol]), F.col(p)).alias(p))
    extra = [F.col(c) for c in added if keep_vectors and not c.endswith("_prediction")]
    result = out.select(*[F.col(c) for c in base_cols], *extra, *preds)
    if replace_label is not None:
        (model,) = list(models.values())
        result = result.drop(replace_label).withColumnRenamed(model_prediction_col(model), replace_label)
    return result
