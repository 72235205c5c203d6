"""Numbered documents, batch folders, and releases of models."""

import threading

import pytest
from pyspark.sql import functions as F

from lotcast.ml import Registry, fit_all, prediction_col, score
from lotcast.ml.models import REGRESSION
from lotcast.session import scratch_path
from lotcast.sinks import commits
from lotcast.streaming import open_stream, read_released_scores, score_stream_released


def _models(spark, value):
    """Two models that both predict ``value``: a mix of releases shows."""
    rows = spark.createDataFrame([(float(i), float(value)) for i in range(4)], "x double, y double")
    return {n: fit_all(rows, ["x"], "y", REGRESSION, prefix=n[:1], only=[n])[n] for n in ("a_linear", "b_linear")}


def test_documents_never_change_and_conflicts_show(spark):
    docs = commits.Documents(spark, scratch_path(spark, "t_docs"))
    assert docs.latest() == 0
    assert docs.publish({"x": 1}) == 1 and docs.publish({"x": 2}, after=1) == 2
    assert docs.publish({"x": 3}, after=1) is None and docs.read(2) == {"x": 2}
    assert docs.publish({"x": "späť"}) == 3 and docs.read(3) == {"x": "späť"}
    docs.drop_below(3)
    assert docs.numbers() == [3]


def test_writers_at_once_get_numbers_of_their_own(spark):
    docs = commits.Documents(spark, scratch_path(spark, "t_docs"))
    got = []
    many = [threading.Thread(target=lambda n=n: got.append((docs.publish(n), n))) for n in range(8)]
    [t.start() for t in many]
    [t.join() for t in many]
    assert sorted(n for n, _ in got) == list(range(1, 9))
    assert all(docs.read(n) == content for n, content in got)


def test_batches_appear_once_and_whole(spark):
    root = scratch_path(spark, "t_batches")
    held = commits.BatchFolder(spark, root)
    rows = spark.createDataFrame([(1,), (2,)], "x int")
    assert held.read(rows.schema).count() == 0
    assert held.commit(rows, "12e4", 0) and not held.commit(rows, "12e4", 0)
    assert held.commit(rows, "12e4", 1) and held.commit(rows, "77", 0)
    broken = rows.withColumn("x", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        held.commit(broken, "77", 1)
    assert not held.holds("77", 1)
    got = held.read(rows.schema, batch_cols=True).groupBy("stream_id", "batch_id").count().collect()
    assert {tuple(r) for r in got} == {("s12e4", 0, 2), ("s12e4", 1, 2), ("s77", 0, 2)}


def test_a_reader_never_meets_a_mix_of_releases(spark):
    root = scratch_path(spark, "t_registry")
    releases = {v: _models(spark, v) for v in range(1, 6)}
    registry, reader = Registry(spark, root), Registry(spark, root)
    with pytest.raises(LookupError):
        reader.models()
    registry.publish(releases[1])
    done, seen, wrong = threading.Event(), [], []

    def read():
        try:
            while not done.is_set() or seen[-1:] != [5]:
                release = reader.current()
                loaded = release.load()
                values = {round(m.stages[-1].predict(m.stages[-1].coefficients * 0), 6) for m in loaded.values()}
                seen.append(release.version)
                if values != {float(release.version)}:
                    wrong.append((release.version, values))
        except Exception as error:  # shown by the assertion below
            wrong.append(error)

    thread = threading.Thread(target=read)
    thread.start()
    for v in range(2, 6):
        registry.publish(releases[v])
    done.set()
    thread.join(120)
    assert not wrong and seen == sorted(seen) and seen[-1] == 5
    registry.prune(keep=2)
    assert registry.releases.numbers() == [4, 5]
    assert len(commits.names(spark, f"{root}/models")) == 2
    assert registry.models(4)[0] == 4 and reader.models()[0] == 5


def test_a_stream_takes_a_release_up_without_a_restart(spark):
    root = scratch_path(spark, "t_released")
    registry = Registry(spark, f"{root}/registry")
    rows = spark.createDataFrame([(float(i), i) for i in range(10)], "x double, nr long")
    registry.publish(_models(spark, 1))
    rows.where("nr < 5").write.parquet(f"{root}/in")
    out, ckpt = f"{root}/out", f"{root}/ckpt"
    query = score_stream_released(open_stream(spark, f"{root}/in", rows.schema), registry, out, ckpt, trigger="1 second")
    query.processAllAvailable()
    registry.publish(_models(spark, 2))
    rows.where("nr >= 5").write.mode("append").parquet(f"{root}/in")
    query.processAllAvailable()
    query.stop()
    got = read_released_scores(spark, out, rows.schema, ["a_linear", "b_linear"]).collect()
    assert {(r["nr"], r["model_version"]) for r in got} == {(i, 1 if i < 5 else 2) for i in range(10)} and len(got) == 10
    assert all(round(r[prediction_col(m)], 6) == r["model_version"] for r in got for m in ("a_linear", "b_linear"))


def test_a_batch_that_runs_again_keeps_its_release_and_its_rows(spark, monkeypatch):
    """The first run dies after the release was chosen; the batch runs again
    after a newer release, then once more when it is there already."""
    root = scratch_path(spark, "t_again")
    registry = Registry(spark, f"{root}/registry")
    registry.publish(_models(spark, 1))
    rows = spark.createDataFrame([(float(i), i) for i in range(6)], "x double, nr long")
    rows.write.parquet(f"{root}/in")
    out, ckpt = f"{root}/out", f"{root}/ckpt"

    def run():
        score_stream_released(open_stream(spark, f"{root}/in", rows.schema), registry, out, ckpt).awaitTermination()

    commit = commits.BatchFolder.commit
    monkeypatch.setattr(commits.BatchFolder, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("executor gone")))
    with pytest.raises(Exception, match="executor gone"):
        run()
    registry.publish(_models(spark, 2))

    def commit_then_die(self, *a):
        commit(self, *a)
        raise RuntimeError("driver gone")

    monkeypatch.setattr(commits.BatchFolder, "commit", commit_then_die)
    with pytest.raises(Exception, match="driver gone"):
        run()
    monkeypatch.setattr(commits.BatchFolder, "commit", commit)
    run()
    got = read_released_scores(spark, out, rows.schema, ["a_linear", "b_linear"])
    assert sorted((r["nr"], r["model_version"]) for r in got.collect()) == [(i, 1) for i in range(6)]


def test_released_models_leave_unusable_rows_in_place(spark):
    registry = Registry(spark, scratch_path(spark, "t_unusable"))
    registry.publish(_models(spark, 3))
    rows = spark.createDataFrame([(1.0,), (None,), (float("nan"),)], "x double")
    got = [r[prediction_col("a_linear")] for r in score(rows, registry.models()[1]).collect()]
    assert got[0] == pytest.approx(3.0) and got[1:] == [None, None]
