"""Publishing by rename: numbered documents and batch folders.

Readers must never meet a half-written result, and a writer that dies must
leave nothing behind that counts. So everything is written under a hidden name
(readers of a folder skip names that begin with "_") and renamed into place
where nothing of that name may exist yet. All file access goes through the
cluster's Hadoop file systems. Renames of object stores without an atomic
rename are as safe as their connector's committer makes them.
"""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

STREAM_COL, BATCH_COL = "stream_id", "batch_id"


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _files(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _files(spark, path).exists(_path(spark, path))


def delete(spark: SparkSession, path: str) -> None:
    _files(spark, path).delete(_path(spark, path), True)


def make_folder(spark: SparkSession, path: str) -> None:
    _files(spark, path).mkdirs(_path(spark, path))


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, hidden ones left out (no folder: none)."""
    if not exists(spark, folder):
        return []
    found = [s.getPath().getName() for s in _files(spark, folder).listStatus(_path(spark, folder))]
    return sorted(n for n in found if n[0] not in "._")


def size(spark: SparkSession, path: str) -> int:
    return _files(spark, path).getContentSummary(_path(spark, path)).getLength()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename where nothing is yet; False if something is there already."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    _files(spark, target).mkdirs(_path(spark, target).getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _files(spark, target).makeQualified(_path(spark, target)).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(_path(spark, source), _path(spark, target), no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """A small text file, whole or not at all; False if there is one."""
    folder, _, name = path.rpartition("/")
    hidden = f"{folder}/_{name}-{uuid.uuid4().hex}"
    make_folder(spark, folder)
    stream = _files(spark, hidden).create(_path(spark, hidden), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if rename_new(spark, hidden, path):
        return True
    delete(spark, hidden)
    return False


def read_text(spark: SparkSession, path: str) -> str:
    stream = _files(spark, path).open(_path(spark, path))
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def checkpoint_stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns ``checkpoint``: made with the
    checkpoint, kept in it, and gone with it."""
    path = f"{checkpoint.rstrip('/')}/lotcast-stream-id"
    write_new(spark, path, uuid.uuid4().hex)
    return read_text(spark, path)


class Documents:
    """Numbered JSON documents in a folder; the highest number counts.

    A document never changes once it is there, so a reader that holds a
    number holds a consistent state, and of two writers that build on the same
    number one is told that it came second.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def _at(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in names(self.spark, self.folder) if n.endswith(".json") and n[:-5].isdigit()]

    def latest(self) -> int:
        """The highest number, 0 without documents."""
        return max(self.numbers(), default=0)

    def read(self, number: int) -> Any:
        return json.loads(read_text(self.spark, self._at(number)))

    def publish(self, content: Any, after: int | None = None) -> int | None:
        """Publish as the next number. With ``after`` the content builds on
        that document: None if another has been published since."""
        text = json.dumps(content, sort_keys=True)
        while True:
            number = (self.latest() if after is None else after) + 1
            if write_new(self.spark, self._at(number), text):
                return number
            if after is not None:
                return None

    def drop_below(self, number: int) -> None:
        for old in self.numbers():
            if old < number:
                delete(self.spark, self._at(old))


class BatchFolder:
    """Micro-batches of streams, each a folder that appears whole.

    ``foreachBatch`` may run a batch again after a failure. A batch that is
    there already is left as it is, so every batch is in the table once.
    Batches are named by the stream that owns the checkpoint too: a new
    checkpoint counts from 0 again.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        make_folder(spark, self.root)

    def folder(self, stream_id: str, batch_id: int) -> str:
        return f"{self.root}/{STREAM_COL}=s{stream_id}/{BATCH_COL}={batch_id}"

    def holds(self, stream_id: str, batch_id: int) -> bool:
        return exists(self.spark, self.folder(stream_id, batch_id))

    def commit(self, batch: DataFrame, stream_id: str, batch_id: int) -> bool:
        """Write the batch unless it is there; True if this call did."""
        if self.holds(stream_id, batch_id):
            return False
        hidden = f"{self.root}/_writing/{uuid.uuid4().hex}"
        batch.write.parquet(hidden)
        if rename_new(self.spark, hidden, self.folder(stream_id, batch_id)):
            return True
        delete(self.spark, hidden)
        return False

    def read(self, schema: StructType, batch_cols: bool = False) -> DataFrame:
        """All committed batches; ``schema`` without the two batch columns."""
        added = [StructField(STREAM_COL, StringType()), StructField(BATCH_COL, LongType())]
        rows = self.spark.read.schema(StructType([*schema.fields, *added])).parquet(self.root)
        return rows if batch_cols else rows.drop(STREAM_COL, BATCH_COL)
