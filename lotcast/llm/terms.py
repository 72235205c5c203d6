"""Terms of a text and bounded groups of a small table's texts.

A term is a run of ASCII letters, ASCII digits and characters beyond ASCII;
only A-Z are lowered. Both operators that read ``benchmark`` use it."""

from __future__ import annotations

import math
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of item texts held at once on the driver and sent to the tasks.
ITEM_BYTES = 16 << 20

#: Every byte of a term to its lower-case form, all others to a blank. Bytes
#: of 0x80 and above occur in characters beyond ASCII only.
_FORM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))


def terms(raw: bytes | None) -> list[bytes]:
    """The terms of a text given as UTF-8 bytes, in order (NULL: none)."""
    return raw.translate(_FORM).split() if raw else []


def utf8(text: Column) -> Column:
    return text.cast("string").cast("binary")


def item_groups(items: DataFrame, id_col: str, text_col: str, limit: int = ITEM_BYTES) -> list[DataFrame]:
    """The distinct (``id``, ``text`` as bytes) of ``items`` in groups by
    hash, none much over ``limit`` bytes unless it is one item. The number of
    groups follows the size of ``items`` and their sizes are checked here, so
    that a caller may fetch one group at a time."""
    slim = items.select(F.col(id_col).alias("id"), utf8(F.col(text_col)).alias("text")).distinct()
    room = F.coalesce(F.octet_length("text"), F.lit(0)) + 64
    n = max(1, math.ceil((slim.agg(F.sum(room)).first()[0] or 0) / limit))

    def group(of: int) -> Column:
        return F.pmod(F.xxhash64("id", "text"), F.lit(of))

    while n > 1 and slim.groupBy(group(n)).agg(F.sum(room).alias("bytes"), F.count(F.lit(1)).alias("c")) \
            .filter(f"c > 1 and bytes > {2 * limit}").take(1):
        n *= 2
    return [slim.filter(group(n) == g) for g in range(n)]
