"""The sold reports over a stream: counts that follow every arrival."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from lotcast.schemas import COUNT_COL
from lotcast.sinks.commits import Documents, delete, names
from lotcast.streaming.ingest import _trigger

REPORT_SCHEMA = StructType([StructField("report", StringType()), StructField("key", StringType()), StructField(COUNT_COL, LongType())])
#: A row's bucket, and the folder of its file (named apart, so that a bucket's
#: folder can be read by itself).
_BUCKET, _PLACE = "bucket", "part"
_STORED = StructType([*REPORT_SCHEMA.fields, StructField(_BUCKET, IntegerType())])
BUCKETS = 16


class ReportTable:
    """A table of counts by (report, key) that is replaced key by key.

    Keys are dealt into buckets by hash. A change writes new files for the
    buckets it touches and then publishes the list of all buckets' folders, so
    readers see the table before the change or after it, and untouched buckets
    are not rewritten. The number of buckets is fixed with the table.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        self.versions = Documents(spark, f"{self.root}/versions")

    def _folders(self, version: int) -> dict[str, str]:
        if not version:
            return {}
        held = self.versions.read(version)
        if held["buckets"] != self.buckets:
            raise ValueError(f"{self.root} has {held['buckets']} buckets")
        return held["folders"]

    def _rows(self, folders: Mapping[str, str]) -> DataFrame:
        paths = [f"{self.root}/data/{folder}/{_PLACE}={b}" for b, folder in sorted(folders.items())]
        return self.spark.read.schema(_STORED).parquet(*paths) if paths else self.spark.createDataFrame([], _STORED)

    def read(self, version: int | None = None) -> DataFrame:
        """The counts, the newest or those of an earlier version."""
        return self._rows(self._folders(self.versions.latest() if version is None else version)).drop(_BUCKET)

    def merge(self, changed: DataFrame) -> int:
        """Replace the counts of the keys in ``changed`` (each once). The
        counts are whole, not increments, so merging a batch again changes
        nothing. Returns the version."""
        hidden = f"{self.root}/_changes/{uuid.uuid4().hex}"
        bucket = F.pmod(F.xxhash64("report", "key"), F.lit(self.buckets)).cast("int")
        changed.select(*REPORT_SCHEMA.names).withColumn(_BUCKET, bucket).write.parquet(hidden)
        new = self.spark.read.schema(_STORED).parquet(hidden)
        touched = {str(r[_BUCKET]) for r in new.select(_BUCKET).distinct().collect()}  # a number for each bucket at most
        while True:
            version = self.versions.latest()
            folders = self._folders(version)
            if not touched:
                break
            old = self._rows({b: f for b, f in folders.items() if b in touched}).alias("old")
            same = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in (_BUCKET, "report", "key")]
            kept = old.join(new.alias("new"), same, "left_anti")
            folder = uuid.uuid4().hex
            rows = kept.unionByName(new).repartition(_BUCKET).withColumn(_PLACE, F.col(_BUCKET))
            rows.write.partitionBy(_PLACE).parquet(f"{self.root}/data/{folder}")
            published = self.versions.publish({"buckets": self.buckets, "folders": {**folders, **dict.fromkeys(touched, folder)}},
                                              after=version)
            if published:
                version = published
                break
            delete(self.spark, f"{self.root}/data/{folder}")
        delete(self.spark, hidden)
        return version

    def prune(self, keep: int = 2) -> None:
        """Forget all but the newest ``keep`` versions and their files."""
        folders = names(self.spark, f"{self.root}/data")
        kept = sorted(self.versions.numbers())[-max(1, keep):]
        used = {f for v in kept for f in self._folders(v).values()}
        if kept:
            self.versions.drop_below(kept[0])
        for folder in folders:
            if folder not in used:
                delete(self.spark, f"{self.root}/data/{folder}")


def report_counts(df: DataFrame, dimensions: Mapping[str, Column], where: Column | str | None = None) -> DataFrame:
    """``report``, ``key``, ``counts`` as :func:`lotcast.operators.sold_reports`
    gives them, by an expansion that a stream can aggregate."""
    rows = df if where is None else df.where(where)
    each = [F.struct(F.lit(n).alias("report"), c.cast("string").alias("key")) for n, c in dimensions.items()]
    return rows.select(F.inline(F.array(*each))).groupBy("report", "key").agg(F.count(F.lit(1)).alias(COUNT_COL))


def stream_reports(df: DataFrame, dimensions: Mapping[str, Column], table: ReportTable, checkpoint: str,
                   where: Column | str | None = None, trigger: str | None = "availableNow") -> StreamingQuery:
    """Keep ``table`` at the counts of everything the stream has brought.

    The state holds one count a key. Each micro-batch gives the keys whose
    counts have changed, with their new counts, and only those are merged.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch)

    writer = report_counts(df, dimensions, where).writeStream.outputMode("update").foreachBatch(run)
    return _trigger(writer.option("checkpointLocation", checkpoint), trigger).start()
