"""End-to-end listing jobs on listing-shaped rows that Spark derives from
the ``events`` test table (no hand-made data)."""

import json
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from lotcast import schemas as S
from lotcast.functions import encode_messages
from lotcast.plans.listing_jobs import (
    REPORT_TABLES,
    Sink,
    ingest_messages,
    read_landed,
    read_rejects,
    run_batch,
    score_landed,
    score_landed_stream,
)
from lotcast.ml import load_all, prediction_col
from lotcast.operators import split_rejects
from lotcast.plans.listing_tables import listings, messages
from lotcast.session import scratch_path


def listings_from_events(spark, d=SF_SMALL):
    return listings(spark, d)


@pytest.fixture(scope="module")
def batch_result(spark):
    listings = listings_from_events(spark)
    root = scratch_path(spark, "t_listing_csv")
    train, test = listings.randomSplit([0.7, 0.3], seed=3)
    train.write.mode("overwrite").option("header", True).csv(f"{root}/train")
    test.write.mode("overwrite").option("header", True).csv(f"{root}/test")
    # One malformed line (text in the bigint id) in an extra training file.
    bad = train.limit(1).select(*[F.lit("not-a-number").alias(c) if c == "EbayID" else F.col(c)
                                  for c in train.columns])
    bad.write.mode("append").option("header", True).csv(f"{root}/train")
    sink = Sink("parquet", scratch_path(spark, "t_listing_out"))
    return listings, sink, run_batch(spark, f"{root}/train", f"{root}/test", sink,
                                     malformed_table="malformed")


def _band(value, edges):
    """Label of the half-open band a value falls in (NULL: the last)."""
    if value is not None:
        for limit, name in edges[:-1]:
            if value < limit:
                return name
    return edges[-1][1]


def test_batch_job_reports_count_the_training_table(spark, batch_result):
    """All five reports, counted in plain Python from the written table."""
    _, sink, result = batch_result
    assert set(result["tables"]) >= set(REPORT_TABLES)
    sold = [r for r in spark.read.parquet(sink.target("training")).collect() if r["QuantitySold"] == 1.0]

    def bands(spec):
        edges, labels, last = spec
        return [*zip(edges, labels), (None, last)]

    want = {
        "activity": Counter(_band(r["HitCount"], bands(S.ACTIVITY_BANDS)) for r in sold),
        "price": Counter(_band(r["Price"], bands(S.PRICE_BANDS)) for r in sold),
        "ratio": Counter(_band(r["SellerSaleAvgPriceRatio"], bands(S.RATIO_BANDS)) for r in sold),
        "weekday": Counter(r["EndDay"] for r in sold),
    }
    for name, counts in want.items():
        got = spark.read.parquet(sink.target(REPORT_TABLES[name])).collect()
        assert {r[0]: r["counts"] for r in got} == dict(counts), name
    sellers = Counter(r["SellerName"] for r in sold)
    best = sorted(sellers.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert [tuple(r) for r in spark.read.parquet(sink.target(REPORT_TABLES["seller"])).collect()] == best


def test_batch_job_reports_rows_that_models_cannot_use(spark, batch_result):
    _, sink, result = batch_result
    read = lambda name: spark.read.parquet(result["tables"][name])
    for family, features, label in (("price", S.PRICE_FEATURES, "Price"), ("sold", S.SOLD_FEATURES, "QuantitySold")):
        train = read("training")
        _, rejected = split_rejects(train, [*features, label])
        assert read(f"{family}_rejects_train").count() == rejected.count()
        lines = read(f"{family}_rows").collect()
        assert len(lines) == 3 and all(r["n_rows"] == r["n_scored"] + r["n_skipped"] for r in lines)
        assert lines[0]["n_skipped"] == read(f"{family}_rejects_test").count()


def test_batch_job_keeps_malformed_lines_aside(spark, batch_result):
    _, sink, result = batch_result
    bad = spark.read.parquet(result["tables"]["malformed_train"]).collect()
    assert len(bad) == 1 and bad[0]["EbayID"] is None and "not-a-number" in bad[0]["_corrupt_record"]
    assert spark.read.parquet(result["tables"]["malformed_test"]).count() == 0


def test_batch_job_cleaned_and_leaderboards(spark, batch_result):
    listings, sink, result = batch_result
    train = spark.read.parquet(sink.target("training"))
    assert train.where("HitCount <= 0 OR HitCount IS NULL").count() == 0
    assert train.count() == train.distinct().count()
    price = spark.read.parquet(sink.target("indicators_price")).orderBy("id").collect()
    assert [r["algorithm_name"] for r in price] == ["price_linear", "price_random_forest", "price_gbt"]
    assert all(r["rmse"] >= 0 and r["mse"] == pytest.approx(r["rmse"] ** 2) for r in price)
    sold = spark.read.parquet(sink.target("indicators_quantity_sold")).orderBy("id").collect()
    assert [r["algorithm_name"] for r in sold] == ["sold_logistic", "sold_random_forest", "sold_decision_tree"]
    assert all(0 <= r["accurate_rate"] <= 1 and r["recall_rate"] == pytest.approx(r["accurate_rate"])
               for r in sold)


def test_ingest_then_score_batch_and_stream(spark, batch_result):
    listings, _, result = batch_result
    # Wire messages: the 33 string keys (Authenticated included) plus one bad message.
    wire_cols = listings.withColumn("Authenticated", F.lit("1")).withColumn("BidCount", F.lit("3")) \
        .withColumn("PriceBuckets", F.lit("2")).withColumn("IsInMedianRatio10Percent", F.lit("0")) \
        .withColumn("IsInMedianRatio20Percent", F.lit("1")).withColumn("IsInMedianRatio25Percent", F.lit("1"))
    msgs = encode_messages(wire_cols, S.LISTING_MESSAGE_KEYS).select("value")
    msgs = msgs.unionByName(spark.createDataFrame([("this is not json",), ("",)], "value string"))
    src = scratch_path(spark, "t_msgs")
    msgs.write.mode("overwrite").text(src)
    landed, ckpt = scratch_path(spark, "t_landed"), scratch_path(spark, "t_ingest_ckpt")
    for _ in range(2):  # the second run on the same checkpoint must add nothing
        ingest_messages(spark.readStream.schema("value string").text(src), landed, ckpt).awaitTermination()
    typed = read_landed(spark, landed)
    assert typed.count() == listings.count()
    assert sorted(r[0] for r in read_rejects(spark, landed).collect()) == ["", "this is not json"]
    assert typed.where("EbayID IS NULL").count() == 0

    sink = Sink("parquet", scratch_path(spark, "t_scores"))
    written = score_landed(spark, landed, result["models"], sink, reference_shape=True)
    scores = spark.read.parquet(written["listing_scores"])
    assert scores.count() == listings.count()
    assert all(prediction_col(m) in scores.columns for m in result["models"])
    one = spark.read.parquet(written["price_gbt"])
    assert one.columns[-1] == "Price" and len(one.columns) == 32

    out, sckpt = scratch_path(spark, "t_stream_scores"), scratch_path(spark, "t_stream_scores_ckpt")
    score_landed_stream(spark, landed, load_all(result["models"]), out, sckpt).awaitTermination()
    streamed = spark.read.parquet(out)
    assert streamed.count() == listings.count()
    p = prediction_col("price_linear")
    a = streamed.select("EbayID", p).exceptAll(scores.select("EbayID", p)).count()
    assert a == 0


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_landed_plus_rejected_is_every_message(spark, fmt):
    sent = messages(spark, SF_SMALL)
    src = scratch_path(spark, "t_odd_msgs")
    sent.write.parquet(src)
    stream = spark.readStream.schema(sent.schema).parquet(src)
    landed, ckpt = scratch_path(spark, "t_odd_landed"), scratch_path(spark, "t_odd_ckpt")
    ingest_messages(stream, landed, ckpt, fmt=fmt, keep=["event_id"]).awaitTermination()
    keep = sent.select("event_id").schema
    good, bad = read_landed(spark, landed, fmt, keep), read_rejects(spark, landed, fmt, keep)
    rows = {r["event_id"]: r["value"] for r in sent.collect()}
    assert {r["event_id"]: r[0] for r in bad.collect()} == {i: v or "" for i, v in rows.items() if i % 10 == 0}
    names = {r["EbayID"]: r["SellerName"] for r in good.collect()}
    want = {i: json.loads(v).get("SellerName") for i, v in rows.items() if i % 10}
    if fmt == "csv":  # the one text that CSV keeps for NULL
        want = {i: None if n == "\\N" else n for i, n in want.items()}
    assert names == want and good.count() == len(want)
