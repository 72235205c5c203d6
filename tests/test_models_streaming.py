import pytest
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from lotcast.ml import CLASSIFICATION, REGRESSION, evaluate, evaluated_rows, fit_all, load_all, prediction_col, save_all, score
from lotcast.plans.catalogue import K_SCHEMA, _linear_k
from lotcast.session import scratch_path
from lotcast.sources import read_table
from lotcast.streaming import decode_stream, open_stream, stream_to_files
from pyspark.sql.types import IntegerType, StructField, StructType


def _lineitem(spark):
    return read_table(spark, SF_SMALL, "lineitem")


def test_fit_save_load_score_two_models(spark):
    li = _lineitem(spark)
    models = fit_all(li, ["l_quantity", "l_discount"], "l_extendedprice", REGRESSION, prefix="p",
                     only=["p_linear", "p_random_forest"])
    assert set(models) == {"p_linear", "p_random_forest"}
    loaded = load_all(save_all(models, scratch_path(spark, "test_models")))
    a = score(li, models).orderBy("l_orderkey", "l_linenumber", "l_partkey").collect()
    b = score(li, loaded).orderBy("l_orderkey", "l_linenumber", "l_partkey").collect()
    assert len(a) == li.count()
    assert [r[prediction_col("p_linear")] for r in a] == [r[prediction_col("p_linear")] for r in b]
    assert [r[prediction_col("p_random_forest")] for r in a] == \
        [r[prediction_col("p_random_forest")] for r in b]
    assert {prediction_col("p_linear"), prediction_col("p_random_forest")} <= set(score(li, loaded).columns)


def test_linear_matches_closed_form(spark):
    ev = read_table(spark, SF_SMALL, "events").withColumn("k", F.from_json("props", K_SCHEMA)["k"])
    lr = _linear_k(spark, SF_SMALL).stages[-1]
    stats = ev.agg(F.regr_slope("value", "k").alias("s"), F.regr_intercept("value", "k").alias("i")).first()
    assert lr.coefficients[0] == pytest.approx(stats["s"], rel=1e-8, abs=1e-10)
    assert lr.intercept == pytest.approx(stats["i"], rel=1e-8)


def test_score_keeps_rows_with_bad_features(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 6.2), (None, 1.0), (float("nan"), 1.0)],
                               "x double, y double")
    models = fit_all(df, ["x"], "y", REGRESSION, prefix="t", only=["t_linear"])
    out = score(df, models).collect()
    assert len(out) == 5
    preds = [r[prediction_col("t_linear")] for r in out]
    assert preds[3] is None and preds[4] is None
    assert all(p is not None for p in preds[:3])


def test_score_replace_label_shape(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "x double, y double")
    models = fit_all(df, ["x"], "y", REGRESSION, prefix="t", only=["t_linear"])
    out = score(df, models, replace_label="y")
    assert out.columns == ["x", "y"]
    assert [round(r["y"], 6) for r in out.orderBy("x").collect()] == [2.0, 4.0, 6.0]


def test_classifiers_fit_and_predict_labels(spark):
    rows = [(float(i), float(i % 5), 1.0 if i % 5 > 1 else 0.0) for i in range(200)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    models = fit_all(df, ["a", "b"], "label", CLASSIFICATION, prefix="c")
    assert set(models) == {"c_logistic", "c_random_forest", "c_decision_tree"}
    out = score(df, models)
    for name in models:
        vals = {r[0] for r in out.select(prediction_col(name)).distinct().collect()}
        assert vals <= {0.0, 1.0}
    tree_acc = out.select(F.avg((F.col(prediction_col("c_decision_tree")) == F.col("label")).cast("double"))).first()[0]
    assert tree_acc == 1.0


def _stream_once(spark, out, ckpt):
    schema = read_table(spark, SF_SMALL, "events").schema
    stream = open_stream(spark, f"{SF_SMALL}/event[s].parquet", schema)
    decoded = decode_stream(stream, StructType([StructField("k", IntegerType())]), value_col="props",
                            keep=["event_id"])
    stream_to_files(decoded, out, ckpt).awaitTermination()


def test_stream_restart_no_duplicates_equals_batch(spark):
    out, ckpt = scratch_path(spark, "t_stream"), scratch_path(spark, "t_stream_ckpt")
    _stream_once(spark, out, ckpt)
    _stream_once(spark, out, ckpt)  # same checkpoint: nothing new to add
    landed = spark.read.parquet(out)
    events = read_table(spark, SF_SMALL, "events")
    assert landed.count() == events.count()
    batch = events.select("event_id", F.from_json("props", K_SCHEMA)["k"].alias("k"))
    assert landed.select("event_id", "k").exceptAll(batch).count() == 0
    assert batch.exceptAll(landed.select("event_id", "k")).count() == 0


def test_interval_trigger_stream(spark):
    schema = read_table(spark, SF_SMALL, "events").schema
    stream = open_stream(spark, f"{SF_SMALL}/event[s].parquet", schema)
    out, ckpt = scratch_path(spark, "t_interval"), scratch_path(spark, "t_interval_ckpt")
    q = stream_to_files(stream.select("event_id"), out, ckpt, trigger="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == read_table(spark, SF_SMALL, "events").count()


def test_score_stream_each_batch_tags_batches(spark):
    from lotcast.streaming import score_stream_each_batch
    models = {"value_linear": _linear_k(spark, SF_SMALL)}
    schema = read_table(spark, SF_SMALL, "events").schema
    stream = open_stream(spark, f"{SF_SMALL}/event[s].parquet", schema).withColumn(
        "k", F.from_json("props", K_SCHEMA)["k"]).select("event_id", "k")
    out, ckpt = scratch_path(spark, "t_each"), scratch_path(spark, "t_each_ckpt")

    def write_batch(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    score_stream_each_batch(stream, models, write_batch, ckpt).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == read_table(spark, SF_SMALL, "events").count()
    assert {r[0] for r in got.select("batch_id").distinct().collect()} == {0}
    assert prediction_col("value_linear") in got.columns


def _forest(rows, cores):
    """The forest that a session with ``cores`` cores fits (a process of its
    own, as one process holds one session)."""
    import json
    import subprocess
    import sys
    code = f"""
import json, sys
sys.path.insert(0, {ROOT!r})
from lotcast.session import local_session
from lotcast.ml import REGRESSION, fit_all
spark = local_session({cores}, shuffle_partitions={cores}, extra={{"spark.driver.memory": "1g"}})
df = spark.createDataFrame(json.loads(sys.stdin.read()), "x double, z double, y double").repartition({cores})
m = fit_all(df, ["x", "z"], "y", REGRESSION, prefix="p", only=["p_random_forest"], fit_partitions=3)
print("FOREST", m["p_random_forest"].stages[-1].toDebugString.split("\\n", 1)[1].replace("\\n", ";"))
"""
    out = subprocess.run([sys.executable, "-c", code], input=json.dumps(rows), capture_output=True, text=True, timeout=300)
    return out.stdout.split("FOREST", 1)[1]


def test_forest_does_not_depend_on_the_cluster():
    rows = [(float(i % 17), float(i * 7 % 23), float(i * i % 101)) for i in range(600)]
    assert _forest(rows, 2) == _forest(rows, 4)


def test_nan_label_leaves_metrics_finite_and_is_counted(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 6.2), (4.0, 8.0)], "x double, y double")
    models = fit_all(df, ["x"], "y", REGRESSION, prefix="t", only=["t_linear"])
    test = df.unionByName(spark.createDataFrame([(5.0, nan), (6.0, None), (None, 3.0), (nan, 3.0)], "x double, y double"))
    board = evaluate(models, test, "y", REGRESSION).first()
    assert all(v == v and abs(v) < 10 for v in (board["rmse"], board["mse"], board["r2"], board["mae"]))
    rows = evaluated_rows(models, test, "y").first()
    assert (rows["n_rows"], rows["n_scored"], rows["n_skipped"]) == (8, 4, 4)


def test_score_rejects_conflicting_vector_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 5.0), (3.0, 6.1, 7.2)], "x double, z double, y double")
    a = fit_all(df, ["x"], "y", REGRESSION, prefix="t", only=["t_linear"])
    b = fit_all(df, ["z"], "y", REGRESSION, prefix="t", only=["t_linear"])
    with pytest.raises(ValueError):
        score(df, {"one": a["t_linear"], "two": b["t_linear"]})


def test_score_uses_the_models_own_prediction_column(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "x double, y double")
    m = fit_all(df, ["x"], "y", REGRESSION, prefix="t", only=["t_linear"])["t_linear"]
    out = score(df, {"any name": m})
    assert "t_linear_prediction" in out.columns and out.count() == 3


def test_equal_rows_are_fitted_as_one_with_a_weight(spark, monkeypatch):
    from lotcast.ml import models as M
    df = spark.createDataFrame([(float(i % 4), float(i % 4 * 10 + (i % 3 == 0))) for i in range(300)], "x double, y double")
    rows = []
    fit = M.GBTRegressor.fit
    monkeypatch.setattr(M.GBTRegressor, "fit", lambda self, data: rows.append(data.count()) or fit(self, data))
    plain, grouped = (fit_all(df, ["x"], "y", REGRESSION, prefix="t", group_equal=g) for g in (False, True))
    assert rows == [300, 8]
    a, b = (score(df, m).distinct().orderBy("x").collect() for m in (plain, grouped))
    for p, q in zip(a, b):
        assert p["t_random_forest_prediction"] == q["t_random_forest_prediction"]
        assert abs(p["t_linear_prediction"] - q["t_linear_prediction"]) < 1e-9
        assert abs(p["t_gbt_prediction"] - q["t_gbt_prediction"]) < 1e-9


def test_dealt_partitions_grow_in_number_not_in_rows(spark, monkeypatch):
    """As before up to so many rows for each; beyond that there are more, also
    of rows that are all equal."""
    from lotcast.ml import models as M
    df = spark.createDataFrame([(float(i % 17), float(i * 7 % 23)) for i in range(600)] + [(1.0, 1.0)] * 400, "x double, y double")
    parts = lambda rows: [[tuple(r) for r in p] for p in rows.rdd.glom().collect()]
    assert parts(M._dealt(df, 3)) == parts(df.repartition(3, "x", "y").sortWithinPartitions("x", "y"))
    monkeypatch.setattr(M, "FIT_ROWS", 50)
    dealt = parts(M._dealt(df, 3))
    assert len(dealt) == 20 and max(map(len, dealt)) < 150
    assert sorted(r for p in dealt for r in p) == sorted(map(tuple, df.collect()))


def test_boosted_trees_are_fitted_on_cells_of_bins(spark, monkeypatch):
    """The number of cells is bounded by the features' bins, whatever the
    rows, and the trees are those of all rows; a rare value keeps its bin."""
    from lotcast.ml import models as M
    few = spark.createDataFrame([(float(i % 40 == 0), float(i % 50), float((i % 50) ** 2 + i % 7)) for i in range(3000)]
                                + [(9.0, 1.0, -5000.0)] * 3, "a double, b double, y double")
    wide = spark.createDataFrame([(i * 0.37 % 11, i * i * 0.011 % 5, float(i % 3), 10 * (i * 0.37 % 11) - (i * i * 0.011 % 5) ** 2)
                                  for i in range(6000)], "a double, b double, c double, y double")
    rows = []
    fit = M.GBTRegressor.fit
    monkeypatch.setattr(M.GBTRegressor, "fit", lambda self, data: rows.append(data.count()) or fit(self, data))
    fit_all(few, ["a"], "y", REGRESSION, prefix="t", only=["t_gbt"], group_bins=True)
    assert rows == [3003]  # few rows are fitted as they are
    monkeypatch.setattr(M, "CELL_ROWS", 1000)
    for df, features, most in ((few, ["a", "b"], 150), (wide, ["a", "b", "c"], 3200)):
        plain, binned = (fit_all(df, features, "y", REGRESSION, prefix="t", only=["t_gbt"], fit_partitions=2, group_bins=g)
                         for g in (False, True))
        whole, cells = rows[-2:]
        assert cells <= most < whole == df.count()
        loaded = load_all(save_all(binned, scratch_path(spark, "test_models")))
        both = score(score(df, plain).withColumnRenamed("t_gbt_prediction", "p").withColumn("i", F.monotonically_increasing_id()),
                     loaded).orderBy("i").collect()
        if df is few:
            assert all(abs(r["p"] - r["t_gbt_prediction"]) < 1e-6 for r in both)
        else:
            error = [sum((r[c] - r["y"]) ** 2 for r in both) / len(both) for c in ("p", "t_gbt_prediction")]
            assert error[1] < 1.1 * error[0]
            holes = spark.createDataFrame([(None, 1.0, 2.0), (float("nan"), 1.0, 2.0), (1e9, -1e9, 2.0)], "a double, b double, c double")
            got = [r["t_gbt_prediction"] for r in score(holes, loaded).collect()]
            assert got[:2] == [None, None] and got[2] is not None
    assert M._borders([1.0, 1.0, 2.0]) == [-float("inf"), 1.0, pytest.approx(1.0), pytest.approx(2.0), float("inf")]
