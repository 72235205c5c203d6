"""Row digests against ``distinct``, and messages that are sent again."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotcast.operators import clean, distinct_by_digest
from lotcast.operators import dedup as D
from lotcast.session import scratch_path
from lotcast.streaming import open_stream, stream_to_files, without_resent

SCHEMA = "a int, b string, c double, d array<int>, n int, _word string, row binary"


def _rows(seed, n=400):
    rng = random.Random(seed)
    pool = [(rng.choice([None, 0, 1]), rng.choice([None, "", "x", "y" * 50]), rng.choice([None, 0.0, -0.0, float("nan"), 1.5]),
             rng.choice([None, [], [None], [1, 2]]), rng.choice([None, 3]), rng.choice(["p", None]), rng.choice([None, bytearray(b"z")]))
            for _ in range(n // 2)]
    return [rng.choice(pool) for _ in range(n)]


def _same(got, want):
    # 0.0 and -0.0 are one row; which of them stays is open.
    key = lambda r: repr([0.0 if v == 0.0 and isinstance(v, float) else v for v in r])
    assert sorted(map(key, got.collect())) == sorted(map(key, want.collect()))


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_distinct_on_awkward_rows(spark, seed):
    df = spark.createDataFrame(_rows(seed), SCHEMA).repartition(5)
    got = distinct_by_digest(df)
    assert got.columns == df.columns and got.schema == df.schema
    _same(got, df.distinct())


def test_equal_digests_and_full_filters_change_nothing(spark, monkeypatch):
    df = spark.createDataFrame(_rows(3), SCHEMA)
    monkeypatch.setattr(D, "row_digest", lambda df: (F.lit(5).cast("long"), F.coalesce(F.col("a").cast("long") % 2, F.lit(7))))
    _same(distinct_by_digest(df), df.distinct())
    monkeypatch.undo()
    _same(distinct_by_digest(df, most_words=1), df.distinct())


def test_no_rows_no_repeats_and_one_hot_row(spark):
    df = spark.range(1000).withColumn("x", F.col("id") % 7)
    assert distinct_by_digest(df).count() == 1000
    assert distinct_by_digest(df.limit(0)).count() == 0
    hot = df.unionByName(df.filter("id = 3").select(F.explode(F.sequence(F.lit(1), F.lit(5000))).alias("k"), "id", "x").drop("k"))
    assert distinct_by_digest(hot).count() == 1000
    wide = spark.range(50).select(*[(F.col("id") % 5 + i).alias(f"c{i}") for i in range(70)])
    assert distinct_by_digest(wide).count() == 5


def test_null_masks_tell_shifted_rows_apart(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (None, None)], "a int, b int")
    first, second = D.row_digest(df)
    assert df.select(first, second).distinct().count() == 3


def test_only_suspected_rows_are_moved_whole(spark):
    path = scratch_path(spark, "t_digest")
    wide = spark.range(2000).select("id", *[F.lit("v").alias(f"c{i}") for i in range(20)])
    wide.unionByName(wide.filter("id < 10")).write.parquet(path)
    df = spark.read.parquet(path)
    got = distinct_by_digest(df)
    assert got.count() == 2000
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchanges = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert sum("c19" in x for x in exchanges) == 1  # only the moved rows, with all columns
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
    assert clean(df, required=["c1"], positive=[], dedup="digest").count() == 2000


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3) | st.none(), st.text(max_size=2) | st.none()), max_size=30))
def test_any_rows(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string")
    _same(distinct_by_digest(df), df.distinct())


def test_resent_messages_land_once_over_restarts(spark):
    root = scratch_path(spark, "t_resent")
    schema = "value string, offset long, received timestamp"

    def send(rows):
        spark.createDataFrame([(v, o) for v, o in rows], "value string, offset long") \
            .withColumn("received", F.lit("2024-01-01 10:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("offset"))) \
            .coalesce(1).write.mode("append").parquet(f"{root}/in")
        kept = without_resent(open_stream(spark, f"{root}/in", spark.read.parquet(f"{root}/in").schema), ["value"], "received", "30 minutes")
        stream_to_files(kept, f"{root}/out", f"{root}/ckpt").awaitTermination()

    send([("a", 0), ("b", 1), ("a", 2), (None, 3), ("", 4), (None, 5)])
    send([("a", 6), ("c", 7), ("b", 7), ("", 8), (None, 9), ("1:a", 9)])
    got = [r["value"] for r in spark.read.schema(schema).parquet(f"{root}/out").collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, ["a", "b", None, "", "c", "1:a"]))
    # After the time to live a message counts as new: the state doesn't grow for ever.
    send([("z", 200)])
    send([("a", 300)])
    send([("z", 301)])
    got = [r["value"] for r in spark.read.schema(schema).parquet(f"{root}/out").collect()]
    assert got.count("a") == 2 and got.count("z") == 2


def test_batch_frames_lose_all_repeats(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 2)], "v string, n int")
    assert without_resent(df, ["v"], "n", "1 hour").count() == 3
    assert without_resent(df, ["v", "n"], "n", "1 hour").count() == 5
