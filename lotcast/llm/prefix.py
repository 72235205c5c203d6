"""Running sums over one huge ordered group, without one task holding it.

A window over a hot key (a source with a third of all rows, one shard) would
put the whole key in one task. Here the order is cut into ranges by a list of
coarse-to-fine ``levels`` (each level refines the one before and agrees with
the order). Sums per range are pre-aggregated, prefix sums run over the
ranges level by level (each window sees only the children of one coarser
range), and the last window runs inside one finest range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hex_levels(column: str, digits: tuple[int, ...] = (2, 4, 6)) -> list[Column]:
    """Levels for an order by a hex digest: its leading digits (256 children
    a level)."""
    return [F.substring(column, 1, d) for d in digits]


def running_sums(df: DataFrame, keys: list[str], levels: list[Column], order: list[Column],
                 values: dict[str, Column]) -> DataFrame:
    """Add, for every ``name: value`` of ``values``, the sum of ``value``
    over the rows of the same ``keys`` that come before this row in
    ``order`` (exclusive; the first row has 0).

    ``keys`` must hold no NULLs. Rows equal in ``order`` get places in an
    arbitrary order among themselves; make the order total where that
    matters.
    """
    lv = [f"_lv{i}" for i in range(len(levels))]
    vals = {n: f"_v_{n}" for n in values}
    df = df.withColumns({**dict(zip(lv, levels)), **{vals[n]: c.cast("long") for n, c in values.items()}})
    finest = df.groupBy(*keys, *lv).agg(*[F.sum(v).alias(v) for v in vals.values()])
    offsets = None
    for i in range(len(lv)):
        at = keys + lv[: i + 1]
        here = finest if i == len(lv) - 1 else finest.groupBy(*at).agg(*[F.sum(v).alias(v) for v in vals.values()])
        siblings = Window.partitionBy(*(keys + lv[:i])).orderBy(lv[i]).rowsBetween(Window.unboundedPreceding, -1) \
            if keys + lv[:i] else Window.orderBy(lv[i]).rowsBetween(Window.unboundedPreceding, -1)
        here = here.select(*at, *[F.coalesce(F.sum(v).over(siblings), F.lit(0)).alias(f"_o{v}") for v in vals.values()])
        if offsets is None:
            offsets = here
        else:
            above = offsets.select(*keys, *lv[:i], *[F.col(f"_o{v}").alias(f"_a{v}") for v in vals.values()])
            offsets = here.join(above, keys + lv[:i]).select(
                *at, *[(F.col(f"_o{v}") + F.col(f"_a{v}")).alias(f"_o{v}") for v in vals.values()])
    inside = Window.partitionBy(*keys, *lv).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = df.join(offsets, keys + lv)
    out = out.withColumns({n: F.col(f"_o{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0))
                           for n, v in vals.items()})
    return out.drop(*lv, *vals.values(), *[f"_o{v}" for v in vals.values()])
