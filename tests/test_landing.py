"""Compaction of a landed folder, and report tables that follow a stream."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from lotcast.operators import sold_reports
from lotcast.session import scratch_path
from lotcast.sinks import commits
from lotcast.streaming import CompactedFolder, ReportTable, open_stream, report_counts, stream_reports, stream_to_files

SCHEMA = "x long, t string, p boolean"


def _land(spark, root, lo, hi, files=3):
    rows = spark.range(lo, hi).select(F.col("id").alias("x"), F.concat(F.lit("t"), F.col("id")).alias("t"), (F.col("id") % 3 == 0).alias("p"))
    rows.repartition(files).write.mode("append").parquet(f"{root}/in")
    stream = open_stream(spark, f"{root}/in", rows.schema, max_files_per_trigger=1)
    stream_to_files(stream, f"{root}/landed", f"{root}/ckpt", partition_by=["p"]).awaitTermination()
    return rows.schema


def _xs(df):
    rows = df.collect()
    assert all(r["t"] == f"t{r['x']}" and r["p"] == (r["x"] % 3 == 0) for r in rows)
    return sorted(r["x"] for r in rows)


def test_rows_are_there_once_before_during_and_after(spark, monkeypatch):
    root = scratch_path(spark, "t_compact")
    schema = _land(spark, root, 0, 60)
    folder = CompactedFolder(spark, f"{root}/landed", f"{root}/gen", schema, ["p"])
    assert _xs(folder.read()) == list(range(60))
    before = folder.read()  # its files are settled before the compaction
    seen = []
    publish = commits.Documents.publish

    def during(self, *a, **k):
        seen.append(_xs(CompactedFolder(spark, f"{root}/landed", f"{root}/gen", schema, ["p"]).read()))
        return publish(self, *a, **k)

    monkeypatch.setattr(commits.Documents, "publish", during)
    assert folder.compact() == 1
    monkeypatch.undo()
    assert seen == [list(range(60))]
    assert _xs(folder.read()) == _xs(before) == list(range(60))
    assert folder.compact() is None  # nothing new
    _land(spark, root, 60, 90)
    assert _xs(folder.read()) == list(range(90))
    small = len(folder.committed())
    assert folder.compact(fan_in=2) == 2  # merged into one generation of the next level
    state = folder._state(2)
    assert [f["level"] for f in state["folders"]] == [1] and len(folder.read().inputFiles()) < small
    assert _xs(folder.read()) == list(range(90))
    assert folder.vacuum(keep=2) > 0  # the first document's files go, what the second adds stays
    assert _xs(folder.read()) == list(range(90))
    assert folder.vacuum(keep=1) > 0
    _land(spark, root, 90, 120)  # the stream goes on beside it
    assert _xs(folder.read()) == list(range(120))


def test_the_slower_of_two_compactors_leaves_nothing(spark, monkeypatch):
    root = scratch_path(spark, "t_compact2")
    schema = _land(spark, root, 0, 30)
    one, two = (CompactedFolder(spark, f"{root}/landed", f"{root}/gen", schema, ["p"]) for _ in range(2))
    write = CompactedFolder._write

    def slow(self, *a):
        made = write(self, *a)
        monkeypatch.setattr(CompactedFolder, "_write", write)
        assert two.compact() == 1
        return made

    monkeypatch.setattr(CompactedFolder, "_write", slow)
    assert one.compact() is None
    assert _xs(one.read()) == list(range(30))
    assert len(commits.names(spark, f"{root}/gen/data")) == 1


def test_a_compactor_that_dies_changes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "t_compact3")
    schema = _land(spark, root, 0, 30)
    folder = CompactedFolder(spark, f"{root}/landed", f"{root}/gen", schema, ["p"])
    monkeypatch.setattr(commits.Documents, "publish", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("gone")))
    with pytest.raises(RuntimeError):
        folder.compact()
    monkeypatch.undo()
    assert _xs(folder.read()) == list(range(30))
    assert folder.compact() == 1 and folder.vacuum(keep=1) > 0
    assert _xs(folder.read()) == list(range(30))
    assert len(commits.names(spark, f"{root}/gen/data")) == 1  # the dead one's folder went too


def _dimensions():
    return {"name": F.col("name"), "size": F.when(F.col("n") < 3, "small").otherwise("large")}


def _counts(df):
    return {(r["report"], r["key"]): r["counts"] for r in df.collect()}


def test_stream_reports_follow_every_arrival(spark):
    root = scratch_path(spark, "t_reports")
    table = ReportTable(spark, f"{root}/table", buckets=4)
    assert table.read().count() == 0
    everything = []
    for nr in range(3):
        new = [("a", nr), (None, nr), ("é", 7), (f"only{nr}", 1), ("unsold", -1)]
        everything += new
        rows = spark.createDataFrame(new, "name string, n int")
        rows.write.mode("append").parquet(f"{root}/in")
        stream = open_stream(spark, f"{root}/in", rows.schema)
        stream_reports(stream, _dimensions(), table, f"{root}/ckpt", where=F.col("n") >= 0).awaitTermination()
        sold = [r for r in everything if r[1] >= 0]
        want = Counter(("name", n) for n, _ in sold) + Counter(("size", "small" if k < 3 else "large") for _, k in sold)
        assert _counts(table.read()) == dict(want)
        batch = spark.createDataFrame(everything, rows.schema)
        assert _counts(report_counts(batch, _dimensions(), "n >= 0")) == dict(want) == \
            _counts(sold_reports(batch, _dimensions(), where="n >= 0"))


def test_merging_again_changes_nothing_and_untouched_buckets_stay(spark):
    table = ReportTable(spark, scratch_path(spark, "t_table"), buckets=8)
    schema = "report string, key string, counts long"
    assert table.merge(spark.createDataFrame([("r", f"k{i}", i) for i in range(40)] + [("r", None, 1), (None, None, 2)], schema)) == 1
    first = _counts(table.read())
    old = table.read()
    change = spark.createDataFrame([("r", "k3", 99), ("s", "k3", 5), ("r", None, 7)], schema)
    assert table.merge(change) == 2 and table.merge(change) == 3
    assert _counts(table.read()) == _counts(table.read(2)) == {**first, ("r", "k3"): 99, ("s", "k3"): 5, ("r", None): 7}
    assert _counts(old) == _counts(table.read(1)) == first
    assert len({table._folders(2)[b] for b in table._folders(2)}) == 2  # old and new folders side by side
    assert table.merge(change.limit(0)) == 3
    table.prune(keep=1)
    assert table.versions.numbers() == [3] and _counts(table.read())["r", "k3"] == 99
    with pytest.raises(ValueError, match="buckets"):
        ReportTable(spark, table.root, buckets=9).read()


def test_two_writers_lose_no_key(spark, monkeypatch):
    table = ReportTable(spark, scratch_path(spark, "t_table2"), buckets=1)
    schema = "report string, key string, counts long"
    rows = ReportTable._rows

    def meanwhile(self, folders):
        monkeypatch.setattr(ReportTable, "_rows", rows)
        ReportTable(spark, table.root, buckets=1).merge(spark.createDataFrame([("r", "other", 2)], schema))
        return rows(self, folders)

    monkeypatch.setattr(ReportTable, "_rows", meanwhile)
    table.merge(spark.createDataFrame([("r", "mine", 1)], schema))
    assert _counts(table.read()) == {("r", "mine"): 1, ("r", "other"): 2}


def test_compaction_sorts_no_rows(spark, monkeypatch):
    """Rows go from reader to writer partition by partition; a write by
    partition values would sort a task's rows first."""
    from pyspark.sql.readwriter import DataFrameWriter
    root = scratch_path(spark, "t_unsorted")
    schema = _land(spark, root, 0, 60)
    folder = CompactedFolder(spark, f"{root}/landed", f"{root}/gen", schema, ["p"])

    def partition_by(self, *columns):
        raise AssertionError("sorts")

    monkeypatch.setattr(DataFrameWriter, "partitionBy", partition_by)
    assert folder.compact() == 1
    assert sorted(f.split("/")[-2] for f in folder.read().inputFiles()) == ["p=false", "p=true"]
    assert _xs(folder.read()) == list(range(60))
