"""Quality assessment: completeness, uniqueness, consistency, validity, profile."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import (
    NUMERIC, col, columns_of_class, data_columns, nan_to_null, text, type_class,
)
from tableward.functions.scalars import instant, instant_sql, one_decimal
from tableward.operators import checks as C
from tableward.operators.profile import (
    BASE, LENGTHS, NUMBERS, Measure, distinct_counts, distinct_rows, measure,
)
from tableward.operators.quantiles import quantile_values
from tableward.operators.sketches import approximate_profile


def percent(part: Column, whole: Column, if_empty: float) -> Column:
    return F.when(whole == 0, F.lit(float(if_empty))).otherwise(part / whole * 100)


def type_of_column(df: DataFrame) -> str:
    """SQL for the type name of the column a row of a long table is about."""
    pairs = ", ".join(f"{text(f.name)}, {text(f.dataType.simpleString())}" for f in df.schema.fields)
    return f"map({pairs})[column]"


def completeness(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Non-null share of each data column."""
    long = measure(nan_to_null(df), data_columns(df, cfg), BASE, cfg)
    return long.withColumn(
        "completeness_percentage",
        F.round(percent(F.col("non_null_count"), F.col("total_count"), 0), 2),
    )


def completeness_score(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Non-null share of all data cells."""
    raw = percent(F.sum("non_null_count"), F.sum("total_count"), 0)
    return completeness(df, cfg).agg(
        F.round(raw, 2).alias("score"), (raw >= cfg.completeness_min).alias("threshold_met")
    )


def uniqueness(df: DataFrame, cfg: QualityConfig = DEFAULTS, approximate: bool = False) -> DataFrame:
    """Different values among the non-null values of each data column.

    With ``approximate`` they are estimated by sketches in one scan, without a shuffle of values.
    """
    names = data_columns(df, cfg)
    if approximate:
        return approximate_profile(df, names, cfg).select(
            "column", "unique_values", F.col("non_null_count").alias("total_values"),
            F.round(F.coalesce("uniqueness", F.lit(0.0)), 2).alias("uniqueness_percentage"),
        )
    clean = nan_to_null(df)
    counts = measure(clean, names, BASE, cfg)
    # one row per column on either side
    joined = counts.join(F.broadcast(distinct_counts(clean, names)), "column", "left")
    unique = F.coalesce("unique_values", F.lit(0))
    return joined.select(
        "column",
        unique.alias("unique_values"),
        F.col("non_null_count").alias("total_values"),
        F.round(percent(unique, F.col("non_null_count"), 0), 2).alias("uniqueness_percentage"),
    )


def uniqueness_score(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Share of rows that are not a repeat of an earlier row."""
    names = data_columns(df, cfg) or df.columns
    clean = nan_to_null(df)
    different = distinct_rows(clean, names).scalar()
    raw = percent(F.col("distinct_rows"), F.col("total_rows"), 100)
    return (
        clean.agg(F.count("*").alias("total_rows"))
        .withColumn("distinct_rows", different)
        .select(
            "total_rows",
            (F.col("total_rows") - F.col("distinct_rows")).alias("duplicate_rows"),
            F.round(raw, 2).alias("score"),
            (raw >= cfg.uniqueness_min).alias("threshold_met"),
        )
    )


def validity(
    df: DataFrame,
    cfg: QualityConfig = DEFAULTS,
    rules: Mapping[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Share of valid values per column; valid means present, and meeting the
    column's rule when one is given."""
    rules = rules or {}
    clean = nan_to_null(df)
    names = data_columns(df, cfg)
    judged = clean.select(
        *[F.when(rules[c](col(c)), col(c)).alias(c) if c in rules else col(c) for c in names]
    )
    long = measure(judged, names, BASE, cfg)
    return long.select(
        "column",
        F.col("non_null_count").alias("valid_count"),
        "total_count",
        F.round(percent(F.col("non_null_count"), F.col("total_count"), 100), 2).alias("validity_percentage"),
    )


def extreme_fences(
    df: DataFrame, columns: Sequence[str], cfg: QualityConfig = DEFAULTS, width: float | None = None,
    rows: int | None = None,
) -> dict[str, tuple[float, float]]:
    """Quartiles widened by a multiple of their distance, per column."""
    k = cfg.extreme_iqr if width is None else width
    out = {}
    for name, (q1, q3) in quantile_values(df, columns, (0.25, 0.75), cfg, rows).items():
        if q1 is not None and q3 is not None:
            out[name] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def column_quality(
    df: DataFrame,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    checks: Sequence[C.Check] = C.BUILT_IN,
    columns: Sequence[str] | None = None,
    measures: Sequence[Measure] = BASE,
    rows: int | None = None,
) -> DataFrame:
    """One row per column with its counters, consistency score and issues.

    Quartiles come first when a check needs them; all counters then share one
    scan, whatever the number of columns and checks.
    """
    clean = nan_to_null(df)
    names = list(columns) if columns is not None else data_columns(df, cfg)
    numeric = columns_of_class(df, NUMERIC, among=names)
    needs_fences = any(c.name == C.NUMERIC_EXTREMES.name for c in checks)
    fences = extreme_fences(clean, numeric, cfg, rows=rows) if numeric and needs_fences else {}
    ctx = C.Context(instant_sql(now), fences, cfg)
    kinds = {f.name: type_class(f.dataType) for f in df.schema.fields}

    def hits(check: C.Check) -> Measure:
        return Measure(
            f"hit_{check.name}",
            lambda name, c, kind: f"count_if({check.offends(name, c, ctx)})"
            if kind == check.applies_to
            else "CAST(0 AS BIGINT)",
        )

    long = measure(clean, names, [*measures, *[hits(c) for c in checks]], cfg)
    penalties, issues = ["0"], []
    for check in checks:
        found = f"hit_{check.name}"
        members = [text(n) for n in names if kinds[n] == check.applies_to]
        if not members:
            continue
        trigger = check.fires.format(found=found, present="non_null_count", total="total_count", cfg=cfg)
        fired = f"(column IN ({', '.join(members)}) AND non_null_count > 0 AND {trigger})"
        penalties.append(f"CASE WHEN {fired} THEN {check.penalty} ELSE 0 END")
        said = f"format_string({text(check.message)}, {found})" if "%d" in check.message else text(check.message)
        issues.append(f"CASE WHEN {fired} THEN {said} END")
    kept = [c for c in long.columns if not c.startswith("hit_")]
    found_issues = f"array_compact(array({', '.join(issues)}))" if issues else "CAST(array() AS ARRAY<STRING>)"
    return long.selectExpr(
        *kept,
        f"greatest(0, 100 - ({' + '.join(penalties)})) AS consistency_score",
        f"{found_issues} AS issues",
    )


def consistency(df: DataFrame, cfg: QualityConfig = DEFAULTS, **kwargs) -> DataFrame:
    """Consistency score and issues per column."""
    return column_quality(df, cfg, **kwargs).select(
        "column", F.col("consistency_score").alias("score"), "issues"
    )


def column_profiles(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Type, counts, distinct values, numeric moments and text lengths per column."""
    clean = nan_to_null(df)
    names = data_columns(df, cfg)
    long = measure(clean, names, (*BASE, *NUMBERS, *LENGTHS), cfg).withColumn(
        "data_type", F.expr(type_of_column(df))
    )
    return _with_distincts(long, clean, names)


def _with_distincts(long: DataFrame, clean: DataFrame, names: Sequence[str]) -> DataFrame:
    joined = long.join(F.broadcast(distinct_counts(clean, names)), "column", "left")
    return joined.withColumn("unique_values", F.coalesce("unique_values", F.lit(0))).withColumn(
        "null_count", F.col("total_count") - F.col("non_null_count")
    )


def quality_table(
    df: DataFrame,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    checks: Sequence[C.Check] = C.BUILT_IN,
    rows: int | None = None,
) -> DataFrame:
    """Everything known about each column: the long form of the quality report."""
    names = data_columns(df, cfg)
    clean = nan_to_null(df)
    long = column_quality(clean, cfg, now, checks, names, (*BASE, *NUMBERS, *LENGTHS), rows)
    long = _with_distincts(long, clean, names)
    total, present = F.col("total_count"), F.col("non_null_count")
    return long.select(
        "column", F.expr(type_of_column(df)).alias("data_type"),
        "total_count", "non_null_count", "null_count", "unique_values",
        F.round(percent(present, total, 0), 2).alias("completeness_percentage"),
        F.round(percent(F.col("unique_values"), present, 0), 2).alias("uniqueness_percentage"),
        F.round(percent(present, total, 100), 2).alias("validity_percentage"),
        "consistency_score", "issues",
        "min_value", "max_value", "mean_value", "std_deviation",
        "avg_length", "min_length", "max_length",
    )


def recommendations(cfg: QualityConfig = DEFAULTS) -> Column:
    """Messages for missed thresholds, from ``<dimension>_score`` and ``<dimension>_met``."""
    # The wording of the messages.
    wording = (
        ("completeness", "Improve data completeness (current: ", cfg.completeness_min),
        ("uniqueness", "Address duplicate records (current uniqueness: ", cfg.uniqueness_min),
        ("consistency", "Improve data consistency (current: ", cfg.consistency_min),
        ("validity", "Improve data validity (current: ", cfg.validity_min),
    )
    missed = F.array_compact(
        F.array(
            *[
                F.when(
                    ~F.col(f"{name}_met"),
                    F.concat(F.lit(lead), one_decimal(F.col(f"{name}_score").cast("double")), F.lit(f"%, target: {goal:g}%)")),
                )
                for name, lead, goal in wording
            ]
        )
    )
    return F.when(F.size(missed) > 0, missed).otherwise(
        F.array(F.lit("Data quality meets all thresholds"))
    )


_PARTS = ("completeness", "uniqueness", "consistency", "validity")


def _score_row(df: DataFrame, long: DataFrame | None, cfg: QualityConfig, *more: Column) -> DataFrame:
    """The scores from a column table; further aggregates of it ride along."""
    names = data_columns(df, cfg)
    if long is None:
        row = df.agg(F.count("*").alias("total_rows"))
        for part in _PARTS:
            row = row.withColumn(f"{part}_score", F.lit(100.0)).withColumn(f"{part}_met", F.lit(True))
        return (
            row.withColumn("total_columns", F.lit(len(df.columns)))
            .withColumn("duplicate_rows", F.lit(0).cast("bigint"))
            .withColumn("overall_score", F.lit(100.0))
        )
    cells = percent(F.sum("non_null_count"), F.sum("total_count"), 0)
    valid = F.avg(percent(F.col("non_null_count"), F.col("total_count"), 100))
    even = F.avg("consistency_score")
    row = long.agg(
        F.max("total_count").alias("total_rows"),
        F.round(cells, 2).alias("completeness_score"),
        (cells >= cfg.completeness_min).alias("completeness_met"),
        F.round(even, 2).alias("consistency_score"),
        (even >= cfg.consistency_min).alias("consistency_met"),
        F.round(valid, 2).alias("validity_score"),
        (valid >= cfg.validity_min).alias("validity_met"),
        *more,
    ).withColumn("distinct_rows", distinct_rows(nan_to_null(df), names).scalar())
    unique = percent(F.col("distinct_rows"), F.col("total_rows"), 100)
    total = sum((F.col(f"{p}_score") for p in _PARTS[1:]), F.col(f"{_PARTS[0]}_score"))
    return (
        row.withColumn("total_columns", F.lit(len(df.columns)))
        .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))
        .withColumn("uniqueness_score", F.round(unique, 2))
        .withColumn("uniqueness_met", unique >= cfg.uniqueness_min)
        .withColumn("overall_score", total / 4)
        .drop("distinct_rows")
    )


def quality_scores(
    df: DataFrame,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    checks: Sequence[C.Check] = C.BUILT_IN,
) -> DataFrame:
    """One row: the four scores, whether they meet their threshold, and the overall score."""
    long = column_quality(df, cfg, now, checks) if data_columns(df, cfg) else None
    return _score_row(df, long, cfg)


def quality_report(
    df: DataFrame,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    checks: Sequence[C.Check] = C.BUILT_IN,
) -> DataFrame:
    """The report as one nested row, for the JSON sink.

    The column table is computed once, scores and profiles come from the same
    aggregate.  What is gathered is one entry per column of the table.
    """
    if data_columns(df, cfg):
        table = quality_table(df, cfg, now, checks)
        entries = F.array_sort(F.collect_list(F.struct(*table.columns))).alias("column_profiles")
        scores = _score_row(df, table, cfg, entries)
    else:
        scores = _score_row(df, None, cfg).withColumn("column_profiles", F.array())
    parts = [
        F.struct(
            F.col(f"{p}_score").alias("score"),
            F.col(f"{p}_met").alias("threshold_met"),
            *([F.col("duplicate_rows")] if p == "uniqueness" else []),
        ).alias(p)
        for p in _PARTS
    ]
    return scores.withColumn("recommendations", recommendations(cfg)).select(
        instant(now).alias("assessment_timestamp"),
        "total_rows", "total_columns", *parts, "overall_score", "recommendations", "column_profiles",
    )


def amount_and_date_check(
    df: DataFrame, amount: str, date: str, now: datetime | str | None = None, least: float = 0
) -> DataFrame:
    """Domain check for money tables: amounts below a bound and dates ahead of the clock."""
    low = F.count_if(col(amount) < F.lit(least))
    ahead = F.count_if(col(date).cast("timestamp_ntz") > instant(now))
    return df.agg(
        low.alias("low_amounts"),
        percent(low, F.count("*"), 0).alias("low_percentage"),
        ahead.alias("future_dates"),
        percent(ahead, F.count("*"), 0).alias("future_percentage"),
    )
