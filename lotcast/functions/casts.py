"""Lenient text-to-type casts that never fail a job.

Spark 4 runs with ANSI mode on: ``CAST('1.0' AS INT)`` raises and
``TRY_CAST('1.0' AS INT)`` is NULL. Text that came over the wire holds
ints written as ``1.0`` and missing values written as ``nan``, so each
type gets a small expression built from ``try_cast`` only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
)


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text accepted as a number: optional sign, digits with an optional point
# (or a leading point), optional exponent, or the words nan / inf /
# infinity, with optional surrounding blanks.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|nan|inf|infinity)\s*$"


def lenient_double(c: str | Column, nan_to_null: bool = True) -> Column:
    """Text -> double; anything but number text -> NULL; ``nan`` -> NULL
    unless kept.

    The pattern test runs first: a failed ``try_cast`` costs a thrown and
    caught exception per row inside the JVM, a regex test does not, which
    matters on columns where most text is not numeric.
    """
    s = _as_col(c)
    d = F.when(s.rlike(NUMBER_TEXT), s.try_cast(DoubleType()))
    return F.when(~F.isnan(d), d) if nan_to_null else d


def lenient_integral(c: str | Column, dtype: DataType) -> Column:
    """Text -> int/bigint. ``'12'`` -> 12, ``'1.0'`` and ``'1.7'`` -> 1
    (truncation), ``''``, ``'nan'``, ``'abc'``, out of range -> NULL.

    Plain integer text is cast directly, so ids above 2**53 stay exact;
    only text with a point or exponent takes the double hop.
    """
    s = _as_col(c)
    return (F.when(s.rlike(INTEGER_TEXT), s.try_cast(dtype))
            .when(s.rlike(NUMBER_TEXT), s.try_cast(DoubleType()).try_cast(dtype)))


def lenient(c: str | Column, dtype: DataType, nan_to_null: bool = True) -> Column:
    """Dispatch on the target type."""
    if isinstance(dtype, (IntegerType, LongType, ShortType)):
        return lenient_integral(c, dtype)
    if isinstance(dtype, (DoubleType, FloatType)):
        out = lenient_double(c, nan_to_null)
        return out if isinstance(dtype, DoubleType) else out.cast(dtype)
    if isinstance(dtype, StringType):
        return _as_col(c).cast(StringType())
    return _as_col(c).try_cast(dtype)


def cast_lenient(df: DataFrame, schema: StructType, nan_to_null: bool = True) -> DataFrame:
    """Cast the columns named in ``schema`` to its types, leniently.

    Columns of ``df`` not in the schema pass through unchanged; one
    ``select`` so Catalyst sees a single projection.
    """
    targets = {f.name: f.dataType for f in schema.fields}
    return df.select(*[
        lenient(F.col(name), targets[name], nan_to_null).alias(name) if name in targets else F.col(name)
        for name in df.columns
    ])
