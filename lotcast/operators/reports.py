"""Descriptive reports over sold listings: band counts, category counts,
top-k, and all of them in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotcast.functions.bands import band
from lotcast.schemas import COUNT_COL, RANGE_COL


def _filtered(df: DataFrame, where: Column | str | None) -> DataFrame:
    return df if where is None else df.where(where)


def band_counts(df: DataFrame, col: str | Column, bands: tuple, where: Column | str | None = None,
                out_col: str = RANGE_COL, count_col: str = COUNT_COL) -> DataFrame:
    """Rows per labelled band. ``bands`` = (edges, labels, else_label).
    Empty bands give no row. Partial aggregation leaves at most one row
    per band per task before the (tiny) shuffle.
    """
    edges, labels, else_label = bands
    return (_filtered(df, where)
            .select(band(col, edges, labels, else_label).alias(out_col))
            .groupBy(out_col)
            .agg(F.count(F.lit(1)).alias(count_col)))


def category_counts(df: DataFrame, col: str | Column, out_col: str,
                    where: Column | str | None = None, count_col: str = COUNT_COL) -> DataFrame:
    """Rows per value of a column (or expression), e.g. per weekday."""
    c = F.col(col) if isinstance(col, str) else col
    return (_filtered(df, where)
            .select(c.alias(out_col))
            .groupBy(out_col)
            .agg(F.count(F.lit(1)).alias(count_col)))


def top_k(df: DataFrame, col: str | Column, k: int, out_col: str,
          where: Column | str | None = None, count_col: str = COUNT_COL) -> DataFrame:
    """The ``k`` most frequent values, ties broken by the value itself
    (NULL last).

    ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task
    keeps its own top k and only k rows per task reach the final merge.
    A hot key costs nothing extra: the count is combined map-side.
    """
    counts = category_counts(df, col, out_col, where, count_col)
    return counts.orderBy(F.col(count_col).desc(), F.col(out_col).asc_nulls_last()).limit(k)


def sold_reports(df: DataFrame, dimensions: dict[str, Column], where: Column | str | None = None,
                 report_col: str = "report", key_col: str = "key",
                 count_col: str = COUNT_COL) -> DataFrame:
    """Every report in ONE scan: ``GROUPING SETS`` over the dimensions.

    Returns long rows (report, key, counts) with the key as text. The
    reference scanned its table once per report; here the input is read
    once and each row is expanded into one row per report before the
    partial aggregate, so the shuffle carries only distinct keys.
    """
    names = list(dimensions)
    projected = _filtered(df, where).select(
        *[dimensions[n].cast("string").alias(f"_d{i}") for i, n in enumerate(names)])
    dcols = [F.col(f"_d{i}") for i in range(len(names))]
    grouped = projected.groupingSets([[c] for c in dcols], *dcols).agg(
        F.count(F.lit(1)).alias(count_col),
        F.grouping_id(*dcols).alias("_gid"))
    # grouping_id has bit (n-1-i) clear for the dimension in the set.
    n = len(names)
    report = None
    key = None
    for i, name in enumerate(names):
        gid = ((1 << n) - 1) ^ (1 << (n - 1 - i))
        cond = F.col("_gid") == F.lit(gid)
        report = F.when(cond, F.lit(name)) if report is None else report.when(cond, F.lit(name))
        key = F.when(cond, dcols[i]) if key is None else key.when(cond, dcols[i])
    return grouped.select(report.alias(report_col), key.alias(key_col), F.col(count_col))


def split_report(long_df: DataFrame, name: str, out_col: str, top: int | None = None,
                 report_col: str = "report", key_col: str = "key",
                 count_col: str = COUNT_COL) -> DataFrame:
    """One report back out of :func:`sold_reports` output."""
    out = long_df.where(F.col(report_col) == name).select(
        F.col(key_col).alias(out_col), F.col(count_col))
    if top is not None:
        out = out.orderBy(F.col(count_col).desc(), F.col(out_col).asc_nulls_last()).limit(top)
    return out
