"""
alternating the two sides of each comparison (medians of N rounds):

1. metrics: one aggregation for all models vs one evaluator job per
   metric per model (4 regression + 3 classification metrics);
2. scoring: all models chained over one scan vs one scan per model;
3. streaming: scoring only new files vs rescoring the whole history
   after each new file arrives.

    python tools/compare_baseline.py [sf_dir] [rounds] [arrivals]
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from lotcast.ml import REGRESSION, fit_all, prediction_col, score  # noqa: E402
from lotcast.operators import classification_metrics, regression_metrics  # noqa: E402
from lotcast.plans.catalogue import PRICE_INPUTS, PRICE_LABEL  # noqa: E402
from lotcast.session import local_session, scratch_path  # noqa: E402
from lotcast.sources import read_table  # noqa: E402
from lotcast.streaming import open_stream, score_stream  # noqa: E402


def _noop(df):
    df.write.format("noop").mode("overwrite").save()


def _timed(fn):
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    rounds = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    arrivals = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    spark = local_session(8, app="lotcast-compare")
    lineitem = read_table(spark, sf_dir, "lineitem").select(*PRICE_INPUTS, PRICE_LABEL)
    models = fit_all(lineitem, PRICE_INPUTS, PRICE_LABEL, REGRESSION, prefix="price")
    preds = {n: prediction_col(n) for n in models}

    # 1. metrics over a materialized scored table (both sides read the same input)
    scored_path = scratch_path(spark, "cmp_scored")
    score(lineitem, models).withColumn(
        "sold", (F.col(PRICE_LABEL) > 38000).cast("double")).write.parquet(scored_path)
    scored = spark.read.parquet(scored_path)
    cls = {n: (F.col(p) > 38000).cast("double") for n, p in preds.items()}

    def metrics_one_pass():
        regression_metrics(scored, PRICE_LABEL, preds).collect()
        classification_metrics(scored, "sold", cls).collect()

    def metrics_per_job():
        for p in preds.values():
            for m in ("rmse", "mse", "r2", "mae"):
                RegressionEvaluator(labelCol=PRICE_LABEL, predictionCol=p, metricName=m).evaluate(scored)
        for n, c in cls.items():
            df = scored.select(F.col("sold"), c.alias("p"))
            for m in ("accuracy", "f1", "weightedRecall"):
                MulticlassClassificationEvaluator(labelCol="sold", predictionCol="p", metricName=m).evaluate(df)

    # 2. scoring
    def score_one_scan():
        _noop(score(lineitem, models))

    def score_scan_per_model():
        for name, model in models.items():
            _noop(score(lineitem, {name: model}))

    # 3. streaming: the events file arrives again and again
    events_schema = read_table(spark, sf_dir, "events").schema
    k = F.from_json("props", "k int")["k"]
    value_model = fit_all(read_table(spark, sf_dir, "events").withColumn("k", k), ["k"], "value",
                          REGRESSION, prefix="value", only=["value_linear"])

    def land(root, i):
        read_table(spark, sf_dir, "events").write.mode("overwrite").parquet(f"{root}/part={i}")

    def incremental():
        root, out, ckpt = (scratch_path(spark, "cmp_in"), scratch_path(spark, "cmp_out"),
                           scratch_path(spark, "cmp_ckpt"))
        spent = 0.0
        for i in range(arrivals):
            land(root, i)
            stream = open_stream(spark, f"{root}/part=*", events_schema).withColumn("k", k)
            spent += _timed(lambda: score_stream(stream.select("event_id", "k"), value_model, out,
                                                 ckpt).awaitTermination())
        return spent

    def full_rescan():
        root, spent = scratch_path(spark, "cmp_in"), 0.0
        for i in range(arrivals):
            land(root, i)
            hist = spark.read.schema(events_schema).parquet(f"{root}/part=*").withColumn("k", k)
            spent += _timed(lambda: score(hist.select("event_id", "k"), value_model).write
                            .mode("overwrite").parquet(scratch_path(spark, "cmp_full")))
        return spent

    pairs = {
        "metrics": (metrics_one_pass, metrics_per_job),
        "scoring": (score_one_scan, score_scan_per_model),
    }
    res = {f"{k}_{side}": [] for k in list(pairs) + ["streaming"] for side in ("ours", "reference_style")}
    metrics_one_pass(), metrics_per_job()  # warm up
    for _ in range(rounds):
        for key, (ours, ref) in pairs.items():
            res[f"{key}_ours"].append(_timed(ours))
            res[f"{key}_reference_style"].append(_timed(ref))
        res["streaming_ours"].append(incremental())
        res["streaming_reference_style"].append(full_rescan())
    spark.stop()
    print(json.dumps({k: round(statistics.median(v), 3) for k, v in res.items()}))


if __name__ == "__main__":
    main()
