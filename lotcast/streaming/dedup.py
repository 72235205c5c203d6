"""De-duplication of messages that a source sends again."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY = "_message_key"


def message_key(columns: Sequence[str]) -> Column:
    """A 128-bit digest of the columns, NULLs and boundaries included."""
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")),
                        F.lit("-")) for c in columns]
    return F.unhex(F.md5(F.concat(*parts).cast("binary")))


def without_resent(df: DataFrame, columns: Sequence[str], time_col: str, ttl: str) -> DataFrame:
    """A stream without the messages that came before, by the values of
    ``columns``, within ``ttl`` of stream time.

    ``time_col`` is when a message was received (for Kafka its ``timestamp``);
    it drives the watermark. What the state keeps is one digest of 16 bytes a
    message, and for ``ttl`` only, so it is bounded by the messages of that
    time; it survives restarts in the checkpoint. A message that is later than
    the watermark by its own time is dropped as late: choose a ``ttl`` longer
    than the source's disorder. Large states belong in the RocksDB state store
    (``spark.sql.streaming.stateStore.providerClass``).

    A message with a NULL time never expires another and is kept as any other
    within its own digest's time. Works on batch DataFrames too, where it drops
    all repeats.
    """
    keyed = df.withColumn(_KEY, message_key(columns))
    if not df.isStreaming:
        return keyed.dropDuplicates([_KEY]).drop(_KEY)
    return keyed.withWatermark(time_col, ttl).dropDuplicatesWithinWatermark([_KEY]).drop(_KEY)
