"""Forests that are the same on any cluster, without a shuffle.

Spark's forest draws its bootstrap and its split candidates partition by
partition, so the model depends on how the rows lie. Here a row's weight in a
tree is a Poisson draw made from a hash of the row and the tree, which is the
bootstrap of a large table, and the bins of the features come from a sample
that a hash of the row chooses. Each tree is fitted by ``spark.ml`` on the rows
where they are, with the draw as ``weightCol`` and without sampling of its own.

A tree is a fit of its own, so a forest reads its training rows (bin numbers,
label and one hash, persisted) ``trees`` times as often as Spark's forest,
which grows all trees at once; ``parallel`` of them run at a time. In exchange
no row is moved, and the model doesn't change with cores or partitions.

Rows with equal bins and label are alike to a tree but for their draws. If the
different ones are ``GROUPED_ROWS`` at most (the sample tells whether that may
be), one pass adds up their draws for all trees, only the sums are moved, and a
tree is fitted on those: the same tree, but the rows are read once and not for
each tree.

Draws are made of all columns of the row that is given: leave an id among them,
or rows that are equal in everything get one weight. Sums of labels are added
up in partition order, so labels that are no whole numbers may differ in the
last bits. Spark samples 10,000 rows for its own bins; bins with less than a
64th of the hash sample are merged with a neighbour, so all bins occur there.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Bucketizer, SQLTransformer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotcast.ml.models import CLASSIFICATION, FOREST_TREES, REGRESSION, SEED, assembler, prediction_col, usable

#: Rows that bins are made from, at most (a bound for the driver).
SAMPLE_ROWS = 10_000
BINS = 32
#: Rows with different bins or label, at most, for which their draws are added
#: up (Spark looks at all of so many rows for its bins, so none is missed).
GROUPED_ROWS = 10_000
_RARE = 64
# Poisson(1): the probability of at most 0, 1, 2, ... draws.
_UP_TO = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320)]).tolist()


def draws(row_hash: Column, tree: int, seed: int) -> Column:
    """How often a row is in the bag of a tree."""
    u = F.pmod(F.xxhash64(row_hash, F.lit(tree), F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    out = F.lit(float(len(_UP_TO)))
    for n, below in reversed(list(enumerate(_UP_TO))):
        out = F.when(u < below, F.lit(float(n))).otherwise(out)
    return out


def cuts(values: np.ndarray, bins: int = BINS) -> list[float]:
    """Inner borders of at most ``bins`` bins of about equal size: halfway
    between neighbouring values, none that would leave a rare bin."""
    held, counts = np.unique(values, return_counts=True)
    least, out, size, left = max(len(values) / bins, len(values) / _RARE), [], 0, len(values)
    for i in range(len(held) - 1):
        size, left = size + counts[i], left - counts[i]
        if size >= (least if len(held) > bins else len(values) / _RARE) and left >= len(values) / _RARE:
            out.append(float((held[i] + held[i + 1]) / 2))
            size = 0
    return out


def _borders(rows: DataFrame, features: Sequence[str], label: str, bins: int) -> tuple[list[list[float]], int]:
    """Bin borders of every feature, from the rows with the smallest hashes
    (each task sends ``SAMPLE_ROWS`` at most), and how many rows with different
    bins or label are among those."""
    few = rows.select("_hash", *features, label).orderBy(F.xxhash64("_hash"), "_hash", *features).limit(SAMPLE_ROWS).collect()
    if not few:
        raise ValueError("no usable rows to fit on")
    out, bin_of = [], []
    for c in features:
        values = np.array([float(r[c]) for r in few])
        inner = cuts(values, bins)
        out.append([float("-inf"), *(inner or [float(few[0][c])]), float("inf")])
        bin_of.append(np.searchsorted(out[-1][1:-1], values, "right"))
    return out, len(set(zip(*bin_of, (r[label] for r in few))))


def _sums(rows: DataFrame, by: Sequence[str], trees: int, seed: int) -> DataFrame | None:
    """The different rows with their draws for every tree added up, or None if
    they are more than ``GROUPED_ROWS``. They go through the driver, so that no
    fit shuffles."""
    summed = rows.groupBy(*by).agg(*[F.sum(draws(F.col("_hash"), t, seed)).alias(f"_draws{t}") for t in range(trees)])
    held = summed.limit(GROUPED_ROWS + 1).collect()
    return rows.sparkSession.createDataFrame(sorted(held), summed.schema) if len(held) <= GROUPED_ROWS else None


def _combined(family: str, name: str, trees: int) -> SQLTransformer:
    """The forest's prediction from its trees': the mean, or the most votes
    (of equal votes the lower class)."""
    votes = ", ".join(f"{name}_tree{t}" for t in range(trees))
    if family == REGRESSION:
        value = f"aggregate(array({votes}), CAST(0 AS DOUBLE), (a, x) -> a + x) / {trees}"
    else:
        value = (f"-array_max(transform(array_distinct(array({votes})), "
                 f"x -> named_struct('n', size(filter(array({votes}), y -> y = x)), 'c', -x))).c")
    return SQLTransformer(statement=f"SELECT *, {value} AS {prediction_col(name)} FROM __THIS__")


def fit_bagged(df: DataFrame, features: Sequence[str], label: str, family: str, name: str, trees: int = FOREST_TREES,
               seed: int = SEED, bins: int = BINS, parallel: int = 2) -> PipelineModel:
    """A forest of ``trees`` trees as one pipeline: it scores raw rows, saves
    and loads as the models of ``fit_all`` do. The share of features that a
    node looks at is that of Spark's forests."""
    features = list(features)
    rows = df.where(usable(df, features, label)).select(
        *features, F.col(label).cast("double").alias(label), F.xxhash64(*df.columns).alias("_hash"))
    inner = [f"{name}_bin{i}" for i in range(len(features))]
    borders, different = _borders(rows, features, label, bins)
    binned = Bucketizer(splitsArray=borders, inputCols=features, outputCols=inner, handleInvalid="keep")
    vector = VectorAssembler(inputCols=inner, outputCol=f"{name}_bins", handleInvalid="keep")
    slim = binned.transform(rows).select(*inner, label, "_hash")
    sums = _sums(slim, [*inner, label], trees, seed) if different <= GROUPED_ROWS // 4 else None
    if sums is None:
        training = vector.transform(slim).select(f"{name}_bins", label, "_hash").persist(StorageLevel.MEMORY_AND_DISK)
    else:
        training = vector.transform(sums).drop(*inner)

    def fit(tree: int):
        common = dict(featuresCol=f"{name}_bins", labelCol=label, predictionCol=f"{name}_tree{tree}", weightCol="_draws",
                      numTrees=1, bootstrap=False, maxBins=max(bins, 2), seed=seed + tree)
        if family == REGRESSION:
            forest = RandomForestRegressor(featureSubsetStrategy="onethird", **common)
        elif family == CLASSIFICATION:
            forest = RandomForestClassifier(featureSubsetStrategy="sqrt", rawPredictionCol=f"{name}_tree{tree}_raw",
                                            probabilityCol=f"{name}_tree{tree}_probability", **common)
        else:
            raise ValueError(f"unknown family {family!r}")
        drawn = draws(F.col("_hash"), tree, seed) if sums is None else F.col(f"_draws{tree}")
        return forest.fit(training.select(f"{name}_bins", label, drawn.alias("_draws")).where("_draws > 0"))

    try:
        with ThreadPoolExecutor(parallel) as pool:
            grown = list(pool.map(fit, range(trees)))
    finally:
        training.unpersist()
    return PipelineModel(stages=[assembler(features, f"{name}_features"), binned, vector, *grown, _combined(family, name, trees)])
