"""The cleaning flow and its summary."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import col, data_columns, ident, nan_to_null, text
from tableward.functions.names import rename_for_cleaning
from tableward.functions.scalars import instant
from tableward.operators.assess import quality_report, type_of_column
from tableward.operators.dedupe import drop_duplicates
from tableward.operators.missing import impute, null_counts, sparse_columns
from tableward.operators.outliers import handle_outliers
from tableward.operators.profile import BASE, distinct_counts, measure
from tableward.operators.textclean import clean_text, infer_types
from tableward.session import stage


def row_completeness(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Share of a row's data columns that hold a value, in percent."""
    names = data_columns(df, cfg, exclude=cfg.indicator_cols)
    if not names:
        return df
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    value = {c: f"nanvl({ident(c)}, NULL)" if c in floats else ident(c) for c in names}
    held = " + ".join(f"CAST({value[c]} IS NOT NULL AS INT)" for c in names)
    return df.withColumn("completeness_score", F.expr(f"round(({held}) / {len(names)} * 100, 2)"))


def add_indicators(df: DataFrame, cfg: QualityConfig = DEFAULTS, now: datetime | str | None = None) -> DataFrame:
    return row_completeness(df, cfg).transform(
        lambda d: d.select(
            *[col(c) for c in d.columns if c not in cfg.indicator_cols],
            instant(now).alias("cleaned_at"),
            *[col(c) for c in d.columns if c == "completeness_score"],
        )
    )


def clean(
    df: DataFrame,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    order_by: tuple[str, ...] = (),
) -> DataFrame:
    """Duplicates, names, gaps, text, types, outliers, indicators, in this order.

    The de-duplicated table is written once to the shared folder; the passes
    that take decisions then read only the columns they need from it.  The
    result itself stays a lazy chain of projections and filters over it.
    """
    unique = drop_duplicates(nan_to_null(df), order_by=order_by, cfg=cfg)
    base = stage(rename_for_cleaning(unique, cfg), "unique")

    names = data_columns(base, cfg)
    rows, present = null_counts(base, names)
    dropped = set(sparse_columns(rows, present, cfg))
    kept = base.drop(*dropped)
    names = [c for c in names if c not in dropped]
    if cfg.infer_before_impute:
        kept = infer_types(kept, cfg, names)
        rows, present = null_counts(kept, names)
    filled = impute(kept, cfg, names, (rows, {c: present[c] for c in names}))
    typed = infer_types(clean_text(filled, cfg, names), cfg, names)
    return add_indicators(handle_outliers(typed, cfg, names, rows), cfg, now)


def column_stats(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Counts per column of a cleaned table, long form."""
    names = data_columns(df, cfg)
    counts = measure(nan_to_null(df), names, BASE, cfg)
    return counts.join(F.broadcast(distinct_counts(nan_to_null(df), names)), "column", "left").select(
        "column",
        F.expr(type_of_column(df)).alias("data_type"),
        "non_null_count",
        (F.col("total_count") - F.col("non_null_count")).alias("null_count"),
        F.coalesce("unique_values", F.lit(0)).alias("unique_values"),
    )


def row_summary(original: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Rows and columns before and after, in one row."""
    before, after = F.col("original_rows"), F.col("cleaned_rows")
    return (
        original.agg(F.count("*").alias("original_rows"))
        .withColumn("cleaned_rows", cleaned.agg(F.count("*").alias("n")).scalar())
        .select(
            "original_rows",
            "cleaned_rows",
            (before - after).alias("rows_removed"),
            F.when(before == 0, F.lit(0.0)).otherwise((before - after) / before * 100).alias("removal_percentage"),
            F.lit(len(original.columns)).alias("original_columns"),
            F.lit(len(cleaned.columns)).alias("cleaned_columns"),
        )
    )


def cleaning_summary(
    original: DataFrame,
    cleaned: DataFrame,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    report: DataFrame | None = None,
) -> DataFrame:
    """The summary document: one nested row for the JSON sink."""
    report = report if report is not None else quality_report(original, cfg, now)
    stats = column_stats(cleaned, cfg)
    # one entry per column of the table
    as_map = stats.agg(
        F.map_from_entries(
            F.collect_list(
                F.struct("column", F.struct("non_null_count", "null_count", "unique_values"))
            )
        ).alias("m")
    )
    types = ", ".join(f"{text(f.name)}, {text(f.dataType.simpleString())}" for f in cleaned.schema.fields)
    return (
        row_summary(original, cleaned)
        .withColumn("quality_report", report.select(F.struct(*report.columns).alias("r")).scalar())
        .withColumn("cleaning_timestamp", instant(now))
        .withColumn("data_types", F.expr(f"map({types})"))
        .withColumn("column_stats", as_map.scalar())
    )
