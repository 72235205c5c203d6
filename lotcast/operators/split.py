"""Deterministic train/test split without a sort or a shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCALE = 1 << 30


def hash_split(df: DataFrame, weights: Sequence[float], seed: int = 0,
               cols: Sequence[str] | None = None) -> list[DataFrame]:
    """Split rows by a hash of their content into parts of the given weights.

    Every row lands in exactly one part, decided by ``xxhash64`` of its
    columns (all by default) and the seed: the same on every run, on every
    recomputation after a lost executor, and under any partitioning, with
    no sort and no shuffle (``randomSplit`` sorts every partition to get
    the same guarantee). Identical rows fall in the same part, so a
    duplicate cannot sit on both sides of a train/test split.
    """
    if not weights or any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError("weights must be non-negative with a positive sum")
    total = float(sum(weights))
    u = F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in (cols or df.columns)]),
               F.lit(_SCALE)) / F.lit(float(_SCALE))
    parts, lo = [], 0.0
    for i, w in enumerate(weights):
        hi = 1.0 if i == len(weights) - 1 else lo + w / total
        parts.append(df.where((u >= F.lit(lo)) & (u < F.lit(hi))))
        lo = hi
    return parts
