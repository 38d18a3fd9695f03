"""Missing values: null tokens, empty rows and columns, imputation, forward fill."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import (
    BOOLEAN, NUMERIC, TEMPORAL, TEXT, col,  columns_of_class, data_columns, ident, nan_to_null, type_class,
)
from tableward.functions.scalars import null_if_token
from tableward.operators.quantiles import quantile_values, quantiles
from tableward.session import stage


def replace_null_tokens(
    df: DataFrame, cfg: QualityConfig = DEFAULTS, tokens: Iterable[str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Null out cells that, as a whole, are one of the tokens."""
    names = columns_of_class(df, TEXT, among=columns if columns is not None else data_columns(df, cfg))
    marks = tuple(tokens) if tokens is not None else cfg.null_tokens
    return df.withColumns({c: null_if_token(col(c), marks) for c in names}) if names else df


def drop_empty_rows(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Drop rows whose data columns are all missing."""
    names = data_columns(df, cfg)
    return df.dropna(how="all", subset=names) if names else df


def null_counts(df: DataFrame, columns: Sequence[str]) -> tuple[int, dict[str, int]]:
    """Row count and non-null count of each column, from one aggregate row."""
    counts = [f"count({ident(c)}) AS _n{i}" for i, c in enumerate(columns)]
    row = nan_to_null(df).selectExpr("count(*) AS _rows", *counts).first()
    return row["_rows"], {c: row[f"_n{i}"] for i, c in enumerate(columns)}


def drop_empty_columns(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Drop data columns without a single value."""
    names = data_columns(df, cfg)
    _, present = null_counts(df, names)
    return df.drop(*[c for c in names if present[c] == 0])


def sparse_columns(rows: int, present: dict[str, int], cfg: QualityConfig = DEFAULTS) -> list[str]:
    return [c for c, n in present.items() if rows and (rows - n) / rows > cfg.drop_null_share]


def drop_sparse_columns(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Drop data columns missing in more than the configured share of rows."""
    rows, present = null_counts(df, data_columns(df, cfg))
    return df.drop(*sparse_columns(rows, present, cfg))


def most_common(df: DataFrame, column: str) -> str | None:
    """The most frequent value as text, the smallest among equals; None without values.

    Counts are combined on the map side and only one row is fetched.
    """
    top = (
        df.where(col(column).isNotNull())
        .groupBy(col(column).alias("v"))
        .count()
        .orderBy(F.desc("count"), "v")
        .limit(1)
        .select(F.col("v").cast("string"))
        .first()
    )
    return top["v"] if top else None


def fill_values(
    df: DataFrame,
    columns: Sequence[str],
    rows: int,
    present: dict[str, int],
    cfg: QualityConfig = DEFAULTS,
) -> dict[str, Column]:
    """What fills the gaps of each column that has some: text, median or mode."""
    types = {f.name: f.dataType for f in df.schema.fields}
    gaps = [c for c in columns if 0 < present[c] < rows or (present[c] == 0 and type_class(types[c]) == TEXT and rows)]
    fills: dict[str, Column] = {}
    numeric = [c for c in gaps if type_class(types[c]) == NUMERIC]
    medians = quantile_values(df, numeric, (0.5,), cfg, rows) if numeric else {}
    for name in gaps:
        kind = type_class(types[name])
        if kind == TEXT:
            fills[name] = F.lit(cfg.text_fill)
        elif kind == NUMERIC:
            fills[name] = F.lit(medians[name][0])
        elif kind in (BOOLEAN, TEMPORAL):
            value = most_common(df, name)
            if value is not None:
                fills[name] = F.lit(value).cast(types[name])
    return fills


def impute(
    df: DataFrame,
    cfg: QualityConfig = DEFAULTS,
    columns: Sequence[str] | None = None,
    counts: tuple[int, dict[str, int]] | None = None,
) -> DataFrame:
    """Fill gaps: text with a fixed word, numbers with the median, the rest with the mode.

    A number column that has gaps becomes double, since a median may fall
    between two values.
    """
    names = list(columns) if columns is not None else data_columns(df, cfg)
    clean = nan_to_null(df)
    rows, present = counts if counts is not None else null_counts(df, names)
    fills = fill_values(clean, names, rows, present, cfg)
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = {
        c: F.coalesce(col(c).cast("double") if type_class(types[c]) == NUMERIC else col(c), v)
        for c, v in fills.items()
    }
    return clean.withColumns(filled) if filled else clean


def impute_with_subquery(df: DataFrame, column: str, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Median fill with the statistic as a scalar subquery of the plan."""
    median = quantiles(nan_to_null(df), [column], (0.5,), (), cfg).select("value").scalar()
    return df.withColumn(column, F.coalesce(col(column).cast("double"), median))


def forward_fill(
    df: DataFrame, columns: Sequence[str], order_by: Sequence[str], partition_by: Sequence[str]
) -> DataFrame:
    """Carry the last seen value forward within each partition, in a total order.

    A partition key may hold a large part of the table, so its rows are not
    brought into one task.  Rows are range-partitioned by key and order and
    filled inside each range.  Only the first key of a range can go on from the
    range before it, so what has to be carried over is at most one row per
    range, and that table is broadcast.
    """
    if not partition_by:
        raise ValueError("forward_fill needs partition_by")
    ranged = stage(
        nan_to_null(df).repartitionByRange(*partition_by, *order_by).withColumn("_part", F.spark_partition_id()),
        "fill",
    )
    here = (
        W.partitionBy("_part", *partition_by)
        .orderBy(*order_by)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    earlier = (
        W.partitionBy(*partition_by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    )
    order = F.struct(*[col(c) for c in order_by])
    carried = (
        ranged.groupBy("_part", *partition_by)
        .agg(*[F.max_by(col(c), F.when(col(c).isNotNull(), order)).alias(f"_l{i}") for i, c in enumerate(columns)])
        .select(
            F.col("_part").alias("_p"),
            *[col(k).alias(f"_k{i}") for i, k in enumerate(partition_by)],
            *[F.last(f"_l{i}", ignorenulls=True).over(earlier).alias(f"_c{i}") for i in range(len(columns))],
        )
        .where(" OR ".join(f"_c{i} IS NOT NULL" for i in range(len(columns))))
    )
    local = ranged.withColumns({f"_f{i}": F.last(col(c), ignorenulls=True).over(here) for i, c in enumerate(columns)})
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(partition_by):
        same = same & col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(F.broadcast(carried), same, "left")
    slot = {c: i for i, c in enumerate(columns)}
    return joined.select(
        *[
            F.coalesce(F.col(f"_f{slot[c]}"), F.col(f"_c{slot[c]}")).alias(c) if c in slot else col(c)
            for c in df.columns
        ]
    )
