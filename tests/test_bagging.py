"""Forests that don't depend on cores or partitions."""

import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from conftest import ROOT
from lotcast.ml import fit_all, fit_bagged, load_all, prediction_col, save_all, score
from lotcast.ml.bagging import cuts, draws
from lotcast.ml.models import CLASSIFICATION, REGRESSION, model_prediction_col
from lotcast.session import scratch_path


def _rows(spark, n=12_000):
    """More rows than Spark takes for its bins, whole-number labels."""
    h = F.xxhash64("id")
    return spark.range(n).select(
        "id", *[(F.pmod(F.shiftright(h, 9 * i), F.lit(100)) / 7.0).alias(f"f{i}") for i in range(4)]) \
        .withColumn("y", F.floor(F.col("f0") * 10 + F.col("f1") * F.col("f2")).cast("double")) \
        .withColumn("sold", (F.col("f0") > F.col("f3")).cast("double"))


def _trees(model):
    return [s.toDebugString.partition("\n")[2] for s in model.stages if hasattr(s, "toDebugString")]


def test_the_same_forest_under_any_partitioning(spark):
    df = _rows(spark)
    features = ["f0", "f1", "f2", "f3"]
    for family, label in ((REGRESSION, "y"), (CLASSIFICATION, "sold")):
        one, two = (fit_bagged(x, features, label, family, "m", trees=3) for x in (df.repartition(2), df.repartition(7, "f1")))
        assert _trees(one) == _trees(two) and len(set(_trees(one))) == 3


SCRIPT = """
import sys
sys.path[:0] = [{root!r}, {tests!r}]
from lotcast.session import local_session
spark = local_session({cores})
import test_bagging as T
model = T.fit_bagged(T._rows(spark), ["f0", "f1", "f2", "f3"], "y", T.REGRESSION, "m", trees=2)
import hashlib
print("TREES", hashlib.sha256("".join(T._trees(model)).encode()).hexdigest())
"""


def test_the_same_forest_under_two_and_four_cores():
    got = set()
    for cores in (2, 4):
        script = SCRIPT.format(root=ROOT, tests=os.path.dirname(os.path.abspath(__file__)), cores=cores)
        run = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=600)
        got.add(next(x for x in run.stdout.splitlines() if x.startswith("TREES")))
    assert len(got) == 1


def test_no_row_is_shuffled(spark):
    seen = []
    from lotcast.ml import bagging
    grow = bagging.RandomForestRegressor.fit
    df = _rows(spark, 500).repartition(3)
    df.write.parquet(path := scratch_path(spark, "t_bagged"))

    def fit(self, training):
        seen.append(training._jdf.queryExecution().executedPlan().toString())
        return grow(self, training)

    bagging.RandomForestRegressor.fit = fit
    try:
        fit_bagged(spark.read.parquet(path), ["f0", "f1"], "y", REGRESSION, "m", trees=2)
    finally:
        bagging.RandomForestRegressor.fit = grow
    assert len(seen) == 2 and not any("Exchange" in plan for plan in seen)


def test_about_as_good_as_sparks_forest(spark):
    df = _rows(spark)
    train, test = df.where("id % 5 != 0"), df.where("id % 5 = 0")
    features = ["f0", "f1", "f2", "f3"]
    spark_model = fit_all(train, features, "y", REGRESSION, prefix="s", only=["s_random_forest"])
    models = {**spark_model, "b": fit_bagged(train, features, "y", REGRESSION, "b")}
    scored = score(test, load_all(save_all(models, scratch_path(spark, "t_bagged_models"))))
    rmse = {m: RegressionEvaluator(labelCol="y", predictionCol=prediction_col(m)).evaluate(scored) for m in models}
    assert rmse["b"] < 1.25 * rmse["s_random_forest"]
    sold = fit_bagged(train, features, "sold", CLASSIFICATION, "c")
    assert model_prediction_col(sold) == "c_prediction"
    right = score(test, {"c": sold}).agg(F.avg((F.col("c_prediction") == F.col("sold")).cast("double"))).first()[0]
    assert right > 0.8


def test_unusable_rows_and_constant_features(spark):
    nan = float("nan")
    df = spark.createDataFrame([(i, float(i % 5), 1.0, float(i % 5 > 1)) for i in range(200)] + [(900, None, 1.0, 1.0), (901, nan, 1.0, 1.0),
                               (902, 1.0, 1.0, None)], "id long, x double, c double, y double")
    model = fit_bagged(df, ["x", "c"], "y", CLASSIFICATION, "m", trees=3)
    got = {r["id"]: r["m_prediction"] for r in score(df, {"m": model}).collect()}
    assert all(got[i] == float(i % 5 > 1) for i in range(200))
    assert got[900] is None and got[901] is None and got[902] == 0.0
    with pytest.raises(ValueError, match="no usable rows"):
        fit_bagged(df.where("id > 902"), ["x"], "y", REGRESSION, "m")


def test_draws_are_poisson_and_differ_by_tree(spark):
    df = spark.range(20_000).select(*[draws(F.xxhash64("id"), t, 10).alias(f"t{t}") for t in range(2)])
    x = np.array(df.collect())
    assert abs(x.mean() - 1) < 0.03 and abs(x.var() - 1) < 0.06
    assert abs(np.corrcoef(x.T)[0, 1]) < 0.03


def test_cuts_leave_no_rare_bin():
    rng = np.random.default_rng(1)
    for values in (rng.standard_normal(5000), rng.integers(0, 9, 3000).astype(float), np.r_[np.zeros(4990), np.arange(10.0)],
                   np.r_[np.arange(3.0), np.full(997, 7.0)], np.full(10, 2.0), np.arange(40.0)):
        inner = cuts(values)
        sizes = np.bincount(np.searchsorted(inner, values), minlength=len(inner) + 1)
        assert len(inner) < 32 and (sizes >= len(values) / 64).all()
    assert cuts(np.arange(9.0)) == [i + 0.5 for i in range(8)]


def test_rows_with_equal_bins_are_added_up_to_the_same_trees(spark, monkeypatch):
    from lotcast.ml import bagging as B
    df = spark.range(3_000).select("id", (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 7 * 10 + F.col("id") % 2)
                                   .cast("double").alias("y"))
    rows = []
    fit = B.RandomForestRegressor.fit
    monkeypatch.setattr(B.RandomForestRegressor, "fit", lambda self, data: rows.append(data.count()) or fit(self, data))
    few = fit_bagged(df, ["x"], "y", REGRESSION, "m", trees=2)
    assert max(rows) == 14
    monkeypatch.setattr(B, "GROUPED_ROWS", 3)
    many = fit_bagged(df, ["x"], "y", REGRESSION, "m", trees=2)
    assert max(rows) > 1_000 and _trees(few) == _trees(many)
