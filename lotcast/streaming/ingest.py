"""Checkpointed stream ingest: source -> decode -> files, exactly once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lotcast import schemas as S
from lotcast.functions.codec import CORRUPT_COL, decode_messages

DEFAULT_INTERVAL = S.INGEST_INTERVAL

#: How landed CSV is written and read back. Every value is quoted, blanks and
#: empty values stay, NULL is written as \N, and a quoted value may hold line
#: feeds (which is why such a file is read whole; Parquet has no such limit).
LANDED_CSV = {"header": "false", "quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false",
              "ignoreTrailingWhiteSpace": "false", "emptyValue": "", "nullValue": "\\N", "multiLine": "true"}


def open_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                options: dict | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream with a declared schema (file sources never infer).

    ``path`` is a folder or glob; a single file path is not a valid
    streaming source, so point a glob such as ``<dir>/event[s].parquet``
    at one file.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.options(**(options or {})).load(path)


def open_kafka(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Kafka source (needs the connector on the classpath); build the
    options with :func:`lotcast.sources.kafka_options`."""
    return spark.readStream.format("kafka").options(**options).load()


def decode_stream(df: DataFrame, schema: StructType, value_col: str = "value",
                  keep: Sequence[str] = ()) -> DataFrame:
    """Decode JSON messages in a stream; malformed ones keep their text in
    the corrupt column instead of taking their micro-batch down."""
    return decode_messages(df, schema, value_col, keep, CORRUPT_COL)


def _trigger(writer, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def stream_to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                    trigger: str | None = "availableNow", partition_by: Sequence[str] = (),
                    options: dict | None = None, query_name: str | None = None) -> StreamingQuery:
    """Append a stream to files. The file sink with a checkpoint is
    exactly-once: a restarted query resumes at its last committed offsets
    and a retried batch never duplicates rows. ``trigger`` is
    ``"availableNow"`` (drain what is there, then stop), ``"once"`` or an
    interval such as ``"10 seconds"``."""
    writer = (df.writeStream.format(fmt).outputMode("append")
              .option("checkpointLocation", checkpoint).options(**(options or {})))
    if fmt == "csv":
        writer = writer.options(**LANDED_CSV)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return _trigger(writer, trigger).start(path)
