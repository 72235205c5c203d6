"""Batch sources: typed listing reads, test tables, Kafka options."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from lotcast.schemas import KAFKA_MAX_FETCH_BYTES


def read_listings(spark: SparkSession, path: str, schema: StructType, fmt: str = "csv",
                  header: bool = True, options: dict | None = None,
                  corrupt_col: str | None = None) -> DataFrame:
    """Typed read with a declared schema -- never inferred.

    For CSV with a header, Spark maps the schema onto the columns by
    position (the header names are skipped), which is how the listing
    files are laid out. For headerless landed files pass ``header=False``:
    the schema names the positional columns directly, no rename chain.

    A value that does not parse as its type becomes NULL. With
    ``corrupt_col`` (CSV/JSON) such a line also keeps its raw text in that
    column, so malformed input can be set aside instead of passing
    silently as NULLs.
    """
    if corrupt_col:
        schema = StructType(schema.fields + [StructField(corrupt_col, StringType(), True)])
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header)
    if corrupt_col:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    return reader.options(**(options or {})).load(path)


def read_table(spark: SparkSession, sf_dir: str, name: str, schema: StructType | None = None) -> DataFrame:
    """One of the Parquet tables (``<dir>/<name>.parquet``). Without
    ``schema`` Spark reads it from a file's footer."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kafka_options(bootstrap_servers: str, topic: str, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None,
                  max_fetch_bytes: int | None = KAFKA_MAX_FETCH_BYTES, **extra: str) -> dict[str, str]:
    """Options for ``readStream.format("kafka")``.

    Resuming is the checkpoint's job (``startingOffsets`` only applies to a
    query's first run). ``max_fetch_bytes`` keeps the reference consumer's
    15 MiB per-partition fetch ceiling; ``max_offsets_per_trigger`` bounds
    a micro-batch so a backlog is worked off in steps, not in one batch.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if max_fetch_bytes is not None:
        opts["kafka.max.partition.fetch.bytes"] = str(int(max_fetch_bytes))
    opts.update({k: str(v) for k, v in extra.items()})
    return opts
