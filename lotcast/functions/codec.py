"""JSON message codec: rows <-> string-valued JSON, on batch or stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT_COL = "_corrupt_record"


def _one_object(value: Column) -> Column:
    """True for text that is one JSON object, if it is JSON at all: not
    blank, and neither more objects nor other text behind it. Where the first
    closing brace is also the last character nothing can follow. Only other
    texts (braces in a value, nested objects, text behind) are parsed a second
    time, as the first of two elements of an array, so that a second object or
    trailing text shows."""
    trimmed = F.rtrim(value, F.lit(" \t\r\n"))
    listed = F.from_json(F.concat(F.lit("["), value, F.lit(",0]")), "array<string>")
    alone = F.when(F.locate("}", trimmed) == F.length(trimmed), F.lit(True)).otherwise(F.size(listed) == 2)
    return F.coalesce(F.ltrim(value).startswith("{") & alone, F.lit(False))


def decode_messages(df: DataFrame, schema: StructType, value_col: str = "value",
                    keep: Sequence[str] = (), corrupt_col: str | None = CORRUPT_COL) -> DataFrame:
    """Decode a JSON text (or Kafka binary) column into typed columns.

    Missing keys give NULL, extra keys are ignored. A message that is not
    exactly one JSON object -- malformed, blank, NULL, several objects, or an
    object with text behind it -- yields NULL fields and its text in
    ``corrupt_col`` (empty for a NULL message), so one message is always one
    row and never passes as a listing without fields. ``keep`` lists input
    columns carried through (e.g. Kafka ``partition``/``offset``).
    Works unchanged on a streaming DataFrame.
    """
    value = F.col(value_col)
    if dict(df.dtypes).get(value_col) == "binary":
        value = value.cast(StringType())
    marker = corrupt_col or CORRUPT_COL
    parse_schema = StructType(schema.fields + [StructField(marker, StringType(), True)])
    parsed = F.from_json(value, parse_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": marker})
    out = df.select(*[F.col(c) for c in keep], value.alias("_value"), _one_object(value).alias("_one"), parsed.alias("_msg"))
    fields = [F.when(F.col("_one"), F.col("_msg").getField(f.name)).alias(f.name) for f in schema.fields]
    bad = F.when(~F.col("_one") | F.col("_msg").getField(marker).isNotNull(), F.coalesce("_value", F.lit("")))
    return out.select(*keep, *fields, *([bad.alias(corrupt_col)] if corrupt_col else []))


def encode_messages(df: DataFrame, columns: Sequence[str] | None = None,
                    key: Column | str | None = None, as_strings: bool = True) -> DataFrame:
    """Rows -> (``key``, ``value``) JSON text, the shape a Kafka sink takes.

    With ``as_strings`` every field is written as a JSON string (the wire
    format of listing messages). NULL fields are omitted from the JSON,
    which decodes back to NULL.
    """
    names = list(columns or df.columns)
    fields = [F.col(c).cast(StringType()).alias(c) if as_strings else F.col(c) for c in names]
    key_col = F.lit(None).cast(StringType()) if key is None else (F.col(key) if isinstance(key, str) else key)
    return df.select(key_col.cast(StringType()).alias("key"), F.to_json(F.struct(*fields)).alias("value"))
