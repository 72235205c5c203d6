"""The three price regressors and three sold classifiers, fitted on one
cached assembly, saved and loaded as self-contained PipelineModels."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotcast import schemas as S
from lotcast.operators.clean import reject_free


FOREST_TREES = S.FOREST_TREES
SEED = S.SEED

#: Rows of a partition that a fit is dealt into (Spark keeps a few hundred bytes
#: for each row of a tree's training set).
FIT_ROWS = 1_000_000
#: Output column of the number of equal rows that a training row stands for.
COPIES = "_copies"
#: Bins of a feature that a boosted tree chooses its splits from (``spark.ml``'s
#: own bound), and error of their shares.
BINS = 32
BIN_ERROR = 0.001
#: Rows from which ``group_bins`` makes cells; fewer are fitted one by one, with
#: the splits that the fit takes from its own sample.
CELL_ROWS = 1_000_000

REGRESSION = "regression"
CLASSIFICATION = "classification"


def prediction_col(name: str) -> str:
    """Prediction column of the model ``fit_all`` returns under ``name``."""
    return f"{name}_prediction"


def model_prediction_col(model: PipelineModel) -> str:
    """Prediction column a fitted pipeline writes (read from the model; a
    pipeline that ends in SQL writes its last column)."""
    last = model.stages[-1]
    if isinstance(last, SQLTransformer):
        return last.getStatement().removesuffix(" FROM __THIS__").rpartition(" AS ")[2]
    return last.getPredictionCol()


def _estimators(family: str, prefix: str, features_col: str, label: str, seed: int):
    """(name, estimator) pairs; every model writes its own output columns,
    so any number of them can be chained over one DataFrame."""
    def out(name):
        return {"featuresCol": features_col, "labelCol": label,
                "predictionCol": prediction_col(name)}

    def prob(name):
        return {"rawPredictionCol": f"{name}_raw", "probabilityCol": f"{name}_probability"}

    if family == REGRESSION:
        names = [f"{prefix}_linear", f"{prefix}_random_forest", f"{prefix}_gbt"]
        return [
            (names[0], LinearRegression(**out(names[0]))),
            (names[1], RandomForestRegressor(numTrees=FOREST_TREES, seed=seed, **out(names[1]))),
            (names[2], GBTRegressor(seed=seed, **out(names[2]))),
        ]
    if family == CLASSIFICATION:
        names = [f"{prefix}_logistic", f"{prefix}_random_forest", f"{prefix}_decision_tree"]
        return [
            (names[0], LogisticRegression(**out(names[0]), **prob(names[0]))),
            (names[1], RandomForestClassifier(numTrees=FOREST_TREES, seed=seed,
                                              **out(names[1]), **prob(names[1]))),
            (names[2], DecisionTreeClassifier(seed=seed, **out(names[2]), **prob(names[2]))),
        ]
    raise ValueError(f"unknown family {family!r}")


def assembler(features: Sequence[str], features_col: str, handle_invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=features_col,
                           handleInvalid=handle_invalid)


def usable(df: DataFrame, features: Sequence[str], label: str) -> Column:
    """Rows a fit or an evaluation can use: no NULL or NaN in the features or
    the label. Fitting and evaluation share this rule; ``split_rejects``
    shows the rest with the reason."""
    return reject_free(df, [*features, label])


def fit_all(df: DataFrame, features: Sequence[str], label: str, family: str,
            prefix: str | None = None, seed: int = SEED,
            only: Sequence[str] | None = None, fit_partitions: int | None = None,
            group_equal: bool = False, group_bins: bool = False) -> dict[str, PipelineModel]:
    """Fit the family's three models; return name -> PipelineModel.

    Rows that are not :func:`usable` are left out by an explicit filter; call
    ``split_rejects`` on the same columns to keep them visible. The feature
    vectors are persisted once (memory and disk) for all fits -- a single
    fit reads them as they come -- and released afterwards.

    Spark seeds bootstrap and split sampling by partition, so a forest
    depends on the input's partitioning. ``fit_partitions`` fixes it: the rows
    are dealt by a hash of their values into so many partitions, more if there
    are over ``FIT_ROWS`` rows for each, and sorted within, so equal inputs give
    equal models on any cluster. Of rows equal in all values every ``FIT_ROWS``
    go on to the next partition. By default the input's own partitioning
    stays. Each returned pipeline is [assembler,
    model], so it scores raw rows by itself.

    ``group_equal`` is for rows with few different values: models that draw no
    rows are fitted on the different rows, weighted by how often each is there,
    which is the same fit but for the order in which sums are added up. Forests
    draw from all rows.

    ``group_bins`` is for many rows with few features: boosted trees are fitted
    on the cells that the bins of the features make (see :func:`_cells`), so all
    rows are read to make the cells and not again for each level of each tree.
    Less than ``CELL_ROWS`` rows are fitted as they are.
    """
    prefix = prefix or family
    features_col = f"{prefix}_features"
    named = [(n, e) for n, e in _estimators(family, prefix, features_col, label, seed) if only is None or n in only]
    asm = assembler(features, features_col, "error")
    rows = df.select(*features, F.col(label).cast("double").alias(label))
    rows = rows.where(usable(rows, features, label))
    boosted = [n for n, e in named if group_bins and isinstance(e, GBTRegressor)]
    if boosted and rows.count() < CELL_ROWS:
        boosted = []
    drawing = [n for n, e in named if n not in boosted
               and (not group_equal or isinstance(e, (RandomForestRegressor, RandomForestClassifier)))]
    dealt = rows if fit_partitions is None or not drawing else _dealt(rows, fit_partitions)
    training = asm.transform(dealt).select(features_col, label)
    if len(drawing) > 1:
        training = training.persist(StorageLevel.MEMORY_AND_DISK)
    weighted = asm.transform(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).cast("double").alias(COPIES))) \
        .select(features_col, label, COPIES)
    if len(named) > len(drawing) + len(boosted):
        weighted = weighted.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return {name: _fit_boosted(est, name, rows, asm, label) if name in boosted
                else PipelineModel(stages=[asm, est.fit(training) if name in drawing
                                           else est.setWeightCol(COPIES).fit(weighted)])
                for name, est in named}
    finally:
        training.unpersist()
        weighted.unpersist()


def _fit_boosted(est: GBTRegressor, name: str, rows: DataFrame, asm: VectorAssembler, label: str) -> PipelineModel:
    """Boosted trees of squared error, fitted on the cells of the rows."""
    stages, cells = _cells(rows, asm, label, name)
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel(stages=[*stages, est.setFeaturesCol(stages[-1].getOutputCol()).setWeightCol(COPIES).fit(cells)])
    finally:
        cells.unpersist()


def _cells(rows: DataFrame, asm: VectorAssembler, label: str, name: str) -> tuple[list, DataFrame]:
    """The stages that lead from a row to the vector the trees look at, and the
    different vectors with the mean label and the number of their rows.

    A tree sees of a feature only its bin, ``BINS`` at most. A feature of up to
    twice as many values is left as it is (the fit bins it itself), any other is
    replaced by its bin of about equal shares, so there are at most ``2 * BINS``
    to the power of the features' number of vectors, whatever the rows. Rows of
    one vector always go the same way, and where squared error splits and what a
    leaf says depend on the sums of their labels alone: the trees are those of
    all rows, but for the order in which sums are added up (and for features of
    more values, whose bins the fit would take from a sample)."""
    features = asm.getInputCols()
    slim = rows.select(*[F.col(c).cast("double").alias(c) for c in features], label)
    held = slim.agg(*[F.approx_count_distinct(c, 0.02) for c in features]).first()
    many = [c for c, n in zip(features, held) if n > 2 * BINS]
    stages = [asm]
    if many:
        shares = slim.approxQuantile(many, [i / BINS for i in range(1, BINS)], BIN_ERROR)
        inner = {c: f"{name}_bin{i}" for i, c in enumerate(features) if c in many}
        stages.append(Bucketizer(splitsArray=[_borders(s) for s in shares], inputCols=many,
                                 outputCols=list(inner.values()), handleInvalid="keep"))
        stages.append(VectorAssembler(inputCols=[inner.get(c, c) for c in features], outputCol=f"{name}_bins",
                                      handleInvalid="keep"))
        slim = stages[1].transform(slim)
    seen = stages[-1].getInputCols()
    cells = slim.groupBy(*seen).agg(F.avg(label).alias(label), F.count(F.lit(1)).cast("double").alias(COPIES))
    return stages, stages[-1].transform(cells).select(stages[-1].getOutputCol(), label, COPIES)


def _borders(shares: Sequence[float]) -> list[float]:
    """Borders of bins that end with the given values; a value that is given
    twice or more is a bin of its own."""
    inner = {math.nextafter(q, math.inf) for q in shares} | {q for q, after in zip(shares, shares[1:]) if q == after}
    return [-math.inf, *sorted(inner - {math.inf}), math.inf]


def _dealt(rows: DataFrame, least: int) -> DataFrame:
    """Rows in ``least`` partitions or more by a hash of their values."""
    columns = rows.columns
    copies = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias(COPIES))
    total = rows.count()
    parts = max(least, math.ceil(total / FIT_ROWS))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(COPIES) - 1) / FIT_ROWS)))
    blocks = copies.select("*", block.alias("_block"))
    held = F.least(F.lit(FIT_ROWS), F.col(COPIES) - F.col("_block") * FIT_ROWS)
    dealt = blocks.select(*columns, held.cast("int").alias(COPIES), F.pmod(F.hash(*columns) + F.col("_block"), F.lit(parts))
                          .cast("int").alias("_part"))
    dealt = dealt.repartitionById(parts, F.col("_part")).sortWithinPartitions(*columns)
    return dealt.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col(COPIES))).alias("_copy")).select(*columns)


def save_all(models: dict[str, PipelineModel], root: str) -> dict[str, str]:
    """Save every pipeline under ``root/<name>`` (overwrite)."""
    paths = {}
    for name, model in models.items():
        path = f"{root.rstrip('/')}/{name}"
        model.write().overwrite().save(path)
        paths[name] = path
    return paths


def load_all(paths: dict[str, str]) -> dict[str, PipelineModel]:
    return {name: PipelineModel.load(path) for name, path in paths.items()}
