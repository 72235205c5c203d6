"""Column-level building blocks (all JVM-side expressions, no UDFs)."""

from lotcast.functions.bands import band, band_sql
from lotcast.functions.casts import cast_lenient, lenient, lenient_double, lenient_integral
from lotcast.functions.codec import CORRUPT_COL, decode_messages, encode_messages

__all__ = [
    "band", "band_sql", "cast_lenient", "lenient", "lenient_double", "lenient_integral",
    "CORRUPT_COL", "decode_messages", "encode_messages",
]
