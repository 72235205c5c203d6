import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.sql import functions as F

from lotcast.operators import (
    band_counts,
    category_counts,
    classification_metrics,
    clean,
    per_class_recall,
    regression_metrics,
    sold_reports,
    split_rejects,
    split_report,
    top_k,
)
from lotcast import schemas as S

LISTING = "Price double, SellerName string, EndDay string, HitCount int, x double"


def test_clean_hitcount(spark):
    rows = [(1.0, "s", "Monday", h, 0.0) for h in (0, -1, None, 1)]
    out = clean(spark.createDataFrame(rows, LISTING)).collect()
    assert [r["HitCount"] for r in out] == [1]


def test_clean_required_nulls(spark):
    rows = [(None, "s", "Monday", 1, 1.0), (1.0, None, "Monday", 1, 2.0),
            (1.0, "s", None, 1, 3.0), (1.0, "s", "Monday", 1, 4.0)]
    out = clean(spark.createDataFrame(rows, LISTING)).collect()
    assert [r["x"] for r in out] == [4.0]


def test_clean_nan_price(spark):
    df = spark.createDataFrame([(float("nan"), "s", "Monday", 1, 1.0)], LISTING)
    assert clean(df).count() == 1
    assert clean(df, reject_nan=True).count() == 0


def test_clean_dedup(spark):
    rows = [(1.0, "s", "Monday", 1, 5.0), (1.0, "s", "Monday", 1, 5.0),
            (2.0, "s", "Monday", 1, 0.0), (2.0, "s", "Monday", 1, -0.0),
            (3.0, "s", "Monday", 1, float("nan")), (3.0, "s", "Monday", 1, float("nan"))]
    out = clean(spark.createDataFrame(rows, LISTING))
    assert out.count() == 3


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([(s,) for s in "aaaccbb"], "seller string")
    out = top_k(df, "seller", 2, "seller_name").collect()
    assert [(r[0], r[1]) for r in out] == [("a", 3), ("b", 2)]


def test_top_k_plans_as_take_ordered(spark):
    df = spark.createDataFrame([(s,) for s in "aaaccbb"], "seller string")
    plan = top_k(df, "seller", 2, "seller_name")._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_band_counts_no_zero_fill(spark):
    df = spark.createDataFrame([(1.0, 1.0), (15.0, 1.0), (15.0, 0.0)], "Price double, QuantitySold double")
    out = {r[0]: r[1] for r in band_counts(df, "Price", S.PRICE_BANDS, where=F.col("QuantitySold") == 1.0).collect()}
    assert out == {"0-2": 1, "10-20": 1}


def test_sold_reports_equal_separate_reports(spark):
    rows = [(float(i % 37) * 9.5, f"s{i % 5}", ["Mon", "Tue"][i % 2], i % 3 == 0) for i in range(200)]
    df = spark.createDataFrame(rows, "v double, seller string, day string, sold boolean")
    edges, labels, other = S.PRICE_BANDS
    from lotcast.functions import band
    long_df = sold_reports(df, {"price": band("v", edges, labels, other), "day": F.col("day"),
                                "seller": F.col("seller")}, where=F.col("sold")).cache()
    sep_price = band_counts(df, "v", S.PRICE_BANDS, where=F.col("sold"))
    assert sorted(split_report(long_df, "price", "range_name").collect()) == sorted(sep_price.collect())
    sep_day = category_counts(df, "day", "weeks", where=F.col("sold"))
    assert sorted(split_report(long_df, "day", "weeks").collect()) == sorted(sep_day.collect())
    top = split_report(long_df, "seller", "seller_name", top=2).collect()
    assert top == top_k(df, "seller", 2, "seller_name", where=F.col("sold")).collect()


def test_classification_metrics_fixture(spark):
    pairs = [(1, 1), (0, 1), (1, 0), (1, 1), (0, 0), (1, 1)]
    df = spark.createDataFrame([(float(p), float(lab)) for p, lab in pairs], "prediction double, label double")
    m = classification_metrics(df, "label", "prediction").first()
    assert m["accuracy"] == pytest.approx(2 / 3)
    assert m["weighted_recall"] == pytest.approx(2 / 3)
    assert m["f1"] == pytest.approx(2 / 3)
    for metric, ours in (("accuracy", "accuracy"), ("f1", "f1"), ("weightedRecall", "weighted_recall")):
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=metric)
        assert m[ours] == pytest.approx(ev.evaluate(df))


def test_classification_label_never_predicted(spark):
    rows = [(0.0, 0.0), (0.0, 1.0), (0.0, 2.0), (0.0, 0.0)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    m = classification_metrics(df, "label", "prediction").first()
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName="f1")
    assert m["f1"] == pytest.approx(ev.evaluate(df))
    rec = {r["label"]: r["recall"] for r in per_class_recall(df, "label", "prediction").collect()}
    assert rec == {0.0: 1.0, 1.0: 0.0, 2.0: 0.0}


def test_classification_metrics_many_models_one_pass(spark):
    rows = [(float(i % 3), float((i * 7) % 3), float(i % 2)) for i in range(90)]
    df = spark.createDataFrame(rows, "label double, p1 double, p2 double")
    m = {r["algorithm_name"]: r for r in classification_metrics(df, "label", {"a": "p1", "b": "p2"}).collect()}
    for name, col in (("a", "p1"), ("b", "p2")):
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol=col, metricName="f1")
        assert m[name]["f1"] == pytest.approx(ev.evaluate(df))


def test_regression_metrics_perfect(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(10)], "y double, p double")
    m = regression_metrics(df, "y", "p").first()
    assert (m["rmse"], m["mse"], m["r2"], m["mae"]) == (0.0, 0.0, 1.0, 0.0)


def test_regression_metrics_match_evaluator(spark):
    rows = [(1e6 + (i * 37 % 101) * 0.5, 1e6 + (i * 53 % 97) * 0.4) for i in range(500)]
    df = spark.createDataFrame(rows, "y double, p double")
    m = regression_metrics(df, "y", {"m": "p"}).first()
    for metric in ("rmse", "mse", "r2", "mae"):
        ev = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=metric)
        assert m[metric] == pytest.approx(ev.evaluate(df), rel=1e-9, abs=1e-9)


def test_split_rejects(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, float("nan"), 1.0), (3, 2.0, 1.0)], "id int, a double, b double")
    good, bad = split_rejects(df, ["a", "b"])
    assert [r["id"] for r in good.collect()] == [3]
    assert sorted((r["id"], r["reject_reason"]) for r in bad.collect()) == [(1, "null:a"), (2, "nan:a")]
    assert good.count() + bad.count() == df.count()


def test_r2_is_null_when_variance_is_zero(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "y double, p double")
    m = regression_metrics(df, "y", "p").first()
    assert m["r2"] is None and (m["mse"], m["mae"]) == (0.5, 0.5)


def test_hash_split_partitions_rows_deterministically(spark):
    from lotcast.operators import hash_split
    df = spark.range(5000).select((F.col("id") % 1000).alias("a"), (F.col("id") * 3).alias("b"))
    train, test = hash_split(df, [0.8, 0.2], seed=10)
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 5000
    assert 0.75 < n_train / 5000 < 0.85
    assert train.intersect(test).count() == 0
    again, _ = hash_split(df.repartition(7), [0.8, 0.2], seed=10)
    assert sorted(again.collect()) == sorted(train.collect())
    dup = spark.createDataFrame([(1, 2)] * 50, "a long, b long")
    sides = [p.count() for p in hash_split(dup, [0.5, 0.5], seed=1)]
    assert sorted(sides) == [0, 50]


def test_top_k_null_key_sorts_last_on_ties(spark):
    df = spark.createDataFrame([(None,), (None,), ("b",), ("b",), ("a",)], "seller string")
    out = top_k(df, "seller", 2, "seller_name").collect()
    assert [(r[0], r[1]) for r in out] == [("b", 2), (None, 2)]


def test_confusion_cells(spark):
    from lotcast.operators import confusion
    pairs = [(1, 1), (0, 1), (1, 0), (1, 1), (0, 0), (1, 1)]
    df = spark.createDataFrame([(float(p), float(lab)) for p, lab in pairs], "prediction double, label double")
    cells = {(r["label"], r["prediction"]): r["n"] for r in confusion(df, "label", "prediction").collect()}
    assert cells == {(1.0, 1.0): 3, (1.0, 0.0): 1, (0.0, 1.0): 1, (0.0, 0.0): 1}
