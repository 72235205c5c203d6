"""Cleaning: incomplete rows, non-positive activity, duplicates, rejects."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from lotcast.operators.dedup import distinct_by_digest

REASON_COL = "reject_reason"


def _is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (DoubleType, FloatType))


def clean(df: DataFrame, required: Sequence[str] = ("Price", "SellerName", "EndDay"),
          positive: Sequence[str] = ("HitCount",), reject_nan: bool = False,
          dedup: bool | str = True) -> DataFrame:
    """Drop rows missing a required field or with a non-positive activity
    count, then de-duplicate whole rows.

    ``IS NOT NULL`` keeps NaN (SQL semantics); ``reject_nan=True`` drops
    NaN in required float columns as well. ``distinct`` compares all
    columns, treating NaN = NaN and 0.0 = -0.0. It becomes a hash
    aggregate with a map-side partial step, so a row repeated a billion
    times collapses before the shuffle instead of landing in one task.
    """
    cond: Column = F.lit(True)
    for name in required:
        c = F.col(name).isNotNull()
        if reject_nan and _is_float(df, name):
            c = c & ~F.isnan(F.col(name))
        cond = cond & c
    for name in positive:
        cond = cond & (F.col(name) > 0)
    out = df.where(cond)
    if dedup == "digest":
        return distinct_by_digest(out)
    return out.distinct() if dedup else out


def reject_reason(df: DataFrame, features: Sequence[str]) -> Column:
    """First failing feature as ``null:<col>`` / ``nan:<col>``; NULL if clean."""
    checks = []
    for name in features:
        checks.append(F.when(F.col(name).isNull(), F.lit(f"null:{name}")))
        if _is_float(df, name):
            checks.append(F.when(F.isnan(F.col(name)), F.lit(f"nan:{name}")))
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def reject_free(df: DataFrame, features: Sequence[str]) -> Column:
    """True where no feature is NULL or NaN (the same rule as
    :func:`reject_reason`, without building the reason)."""
    ok = F.lit(True)
    for name in features:
        ok = ok & F.col(name).isNotNull()
        if _is_float(df, name):
            ok = ok & ~F.isnan(F.col(name))
    return ok


def tag_rejects(df: DataFrame, features: Sequence[str], reason_col: str = REASON_COL) -> DataFrame:
    """Add the reject reason column (NULL for rows every model can use)."""
    return df.withColumn(reason_col, reject_reason(df, features))


def split_rejects(df: DataFrame, features: Sequence[str],
                  reason_col: str = REASON_COL) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) by null/NaN features. Both halves keep every
    column; ``rejected`` adds the reason. Nothing is dropped: every input
    row is in exactly one half. The split is two filters over one plan --
    persist ``df`` first if it is expensive to recompute.
    """
    tagged = tag_rejects(df, features, reason_col)
    good = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    rejected = tagged.where(F.col(reason_col).isNotNull())
    return good, rejected
