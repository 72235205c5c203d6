"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotcast.session import scratch_path

#: A word: a run of characters other than the six ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables, read through Spark."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage, survives lost executors, and fixes the rows of every later
    pass over them."""
    return stored(df, name)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``materialize`` and the folder, for tables that ``drop_scratch`` deletes
    once nothing reads them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


#: Bytes of a column that per-row Python looks at together.
SLICE_BYTES = 1 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, field: str | None = None) -> Iterator[pa.RecordBatch]:
    """The rows of Arrow batches in stretches of about ``SLICE_BYTES`` of a
    text or binary column (or a field of a struct; a longer value is a stretch
    of its own), so that a task holds the Python objects of few rows whatever a
    batch holds."""
    for batch in batches:
        values = batch.column(column) if field is None else batch.column(column).field(field)
        if not (pa.types.is_string(values.type) or pa.types.is_binary(values.type)
                or pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type)):
            values = values.cast(pa.string())
        ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        start, before = 0, 0
        while start < len(ends):
            stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            yield batch.slice(start, stop - start)
            start, before = stop, int(ends[stop - 1])


def word_count(text: Column) -> Column:
    """Words of a text as a long (NULL text: 0). Counts the positions where
    a word starts instead of building an array of words."""
    starts = F.regexp_replace(text, WORD, "w")
    return F.coalesce(F.length(F.regexp_replace(starts, r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def shuffled_key(doc_id: Column, seed: str = "") -> Column:
    """A fixed pseudo-random order of documents: 32 hex digits, the same in
    any engine with md5 (NULL id: the digest of the seed alone)."""
    return F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
