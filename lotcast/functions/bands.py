"""Labelled half-open bands as one JVM-side CASE expression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def band(col: str | Column, edges: Sequence[float], labels: Sequence[str],
         else_label: str, null_label: str | None = None) -> Column:
    """Map a numeric column to the label of its band.

    ``labels[i]`` covers ``[edges[i-1], edges[i])`` (the first band is open
    below). Values at or above the last edge, NULL and NaN get
    ``else_label`` -- the same catch-all the report SQL uses. Pass
    ``null_label`` to give NULL its own label instead.

    The result is a plain ``CASE WHEN`` chain, so it stays inside
    whole-stage codegen and never leaves the JVM.
    """
    if len(edges) != len(labels):
        raise ValueError("need exactly one label per edge")
    if list(edges) != sorted(edges):
        raise ValueError("edges must be ascending")
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    if null_label is not None:
        expr = F.when(c.isNull(), F.lit(null_label))
    for edge, label in zip(edges, labels):
        cond = c < F.lit(edge)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(else_label))


def band_sql(col_sql: str, edges: Sequence[float], labels: Sequence[str],
             else_label: str) -> str:
    """The same band as ANSI SQL text (used for oracles and SQL users)."""
    whens = " ".join(f"WHEN {col_sql} < {e!r} THEN '{lab}'" for e, lab in zip(edges, labels))
    return f"CASE {whens} ELSE '{else_label}' END"
