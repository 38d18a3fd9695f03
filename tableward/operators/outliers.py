"""Outliers by the inter-quartile range: remove when rare, cap when common."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import NUMERIC, col, columns_of_class, data_columns, ident, nan_to_null, number
from tableward.operators.assess import extreme_fences
from tableward.operators.quantiles import quantiles


def quartiles(df: DataFrame, columns: Sequence[str], cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """First and third quartile per column, as a table."""
    at = quantiles(nan_to_null(df), list(columns), (0.25, 0.75), (), cfg)
    return at.groupBy("column").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )


def iqr_bounds(
    df: DataFrame, columns: Sequence[str], cfg: QualityConfig = DEFAULTS, rows: int | None = None
) -> dict[str, tuple[float, float]]:
    return extreme_fences(df, columns, cfg, cfg.outlier_iqr, rows)


def remove_outside(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Keep rows inside the bounds; a missing value is not inside."""
    for name, (lo, hi) in bounds.items():
        df = df.where(col(name).between(F.lit(lo), F.lit(hi)))
    return df


def cap(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Move values outside the bounds onto them; missing values stay missing."""
    def capped(name: str, lo: float, hi: float) -> Column:
        value = col(name).cast("double")
        return F.when(value.isNotNull(), F.greatest(F.least(value, F.lit(hi)), F.lit(lo)))

    return df.withColumns({n: capped(n, *b) for n, b in bounds.items()}) if bounds else df


def _outlier_counts(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> tuple[int, dict[str, int]]:
    far = [
        f"count_if({ident(n)} < {number(lo)} OR {ident(n)} > {number(hi)}) AS o{i}"
        for i, (n, (lo, hi)) in enumerate(bounds.items())
    ]
    row = df.selectExpr("count(*) AS rows", *far).first()
    return row["rows"], {n: row[f"o{i}"] for i, n in enumerate(bounds)}


def handle_outliers(
    df: DataFrame,
    cfg: QualityConfig = DEFAULTS,
    columns: Sequence[str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Remove or cap the outliers of each numeric column, left to right.

    A column's bounds and its outlier share are those of the rows that earlier
    columns left over.  Only a removal changes what later columns see, so the
    statistics of all remaining columns are taken together and taken again
    only after a removal: two jobs per removing column, not per column.
    ``outlier_mode="joint"`` judges every column on the input rows instead.
    """
    names = columns_of_class(df, NUMERIC, among=columns if columns is not None else data_columns(df, cfg))
    df = nan_to_null(df)
    pending = list(names)
    while pending:
        bounds = iqr_bounds(df, pending, cfg, rows)
        if not bounds:
            return df
        total, found = _outlier_counts(df, bounds)
        rows = total
        rare = [n for n in bounds if found[n] and found[n] / total < cfg.outlier_remove_share]
        common = [n for n in bounds if found[n] and n not in rare]
        if cfg.outlier_mode == "joint":
            kept = remove_outside(df, {n: bounds[n] for n in rare})
            return cap(kept, {n: bounds[n] for n in common})
        first_removal = pending.index(rare[0]) if rare else len(pending)
        df = cap(df, {n: bounds[n] for n in common if pending.index(n) < first_removal})
        if not rare:
            return df
        df = remove_outside(df, {rare[0]: bounds[rare[0]]})
        rows = total - found[rare[0]]  # an upper bound: rows missing the value go too
        pending = pending[first_removal + 1 :]
    return df
