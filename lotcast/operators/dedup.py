"""Whole-row de-duplication that moves only the rows that may be repeated.

``distinct`` shuffles every row with all its columns. Here the first pass
shuffles a 128-bit digest of each row, summed up in the tasks, and leaves the
digests that occur more than once. They go into a blocked Bloom filter: a table
of 64-bit words, each digest setting a few bits of one word. The second pass
looks every row up in it (a broadcast of bounded size). A row that the filter
doesn't know has no equal and stays where it is; the others are moved and
compared in full by ``distinct``. False hits of the filter and equal digests of
different rows only move a row more; the result is that of ``distinct``.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lotcast.session import scratch_path

#: Words of the filter at most (64 bits each) and digests a word: beyond
#: ``MOST_WORDS * PER_WORD`` repeated digests all rows are moved.
MOST_WORDS = 1 << 22
PER_WORD = 6
_BITS = 4


def _equal_form(df: DataFrame, name: str) -> Column:
    """0.0 and -0.0 are equal to ``distinct`` (as is NaN to NaN)."""
    c = F.col(f"`{name}`")
    return c + F.lit(0.0).cast(df.schema[name].dataType) if isinstance(df.schema[name].dataType, (DoubleType, FloatType)) else c


def row_digest(df: DataFrame) -> tuple[Column, Column]:
    """Two 64-bit hashes of all columns. Hash functions pass over NULLs, so
    which columns are NULL is hashed as well."""
    columns = [_equal_form(df, c) for c in df.columns]
    nulls = [reduce(Column.__add__, [F.col(f"`{c}`").isNull().cast("long") * (1 << i) for i, c in enumerate(part)])
             for part in (df.columns[s: s + 62] for s in range(0, len(df.columns), 62))]
    return tuple(F.xxhash64(F.lit(seed), *nulls, *columns) for seed in (11, 7919))


def _bits(digest: Column) -> Column:
    """A few bits of one word, from six bits of the digest each."""
    one = F.lit(1).cast("long")
    places = [F.shiftright(digest, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(_BITS)]
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, p) for p in places])


def _suspects(rows: DataFrame, words: int) -> DataFrame:
    """``word``, ``bits``: the filter, one row a used word."""
    return (rows.select(F.pmod("_d0", F.lit(words)).alias("_word"), _bits(F.col("_d1")).alias("_bits"))
            .groupBy("_word").agg(F.bit_or("_bits").alias("_held")))


def distinct_by_digest(df: DataFrame, most_words: int = MOST_WORDS) -> DataFrame:
    """The distinct rows of ``df``. Runs a job for the digests; reads ``df``
    three times in all, so give it something that is cheap to read again."""
    spark, columns = df.sparkSession, df.columns
    if not columns:
        return df.distinct()
    first, second = row_digest(df)
    # The row is one column here, so that no name of its own can clash.
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), first.alias("_d0"), second.alias("_d1"))
    path = scratch_path(spark, "repeated-digests")
    rows.groupBy("_d0", "_d1").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_d0", "_d1").write.parquet(path)
    repeated = spark.read.schema("_d0 long, _d1 long").parquet(path)
    n = repeated.count()
    if n == 0:
        return df
    words = max(1 << 10, 1 << math.ceil(math.log2(n / PER_WORD))) if n > PER_WORD else 1 << 10
    if words > most_words:  # most rows are moved anyway
        return df.distinct()
    held = F.broadcast(_suspects(repeated, words))  # a row a word at most
    marked = rows.withColumns({"_word": F.pmod("_d0", F.lit(words)), "_bits": _bits(F.col("_d1"))}).join(held, "_word", "left")
    known = F.coalesce(F.col("_held").bitwiseAND(F.col("_bits")) == F.col("_bits"), F.lit(False))
    return marked.filter(~known).select("row.*").unionByName(marked.filter(known).select("row.*").distinct())
