"""Exploration: the numbers behind summaries and charts, as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.config import DEFAULTS, RECENCY_HOURS, QualityConfig
from tableward.functions.columns import (
    NUMERIC, TEXT, chart_columns, col, columns_of_class, data_columns, ident, nan_to_null, number, text, type_class,
)
from tableward.functions.scalars import instant
from tableward.operators.assess import column_profiles
from tableward.operators.missing import most_common
from tableward.operators.profile import one_row_to_long
from tableward.operators.quantiles import quantile_values, quantiles
from tableward.operators.sketches import K, quantile_at
from tableward.session import stage

_QUARTILES = (0.25, 0.5, 0.75)
# Rows a limit with offset may keep per task before the ranged way is taken.
_OFFSET_IN_MEMORY = 100_000


# -- summaries ---------------------------------------------------------------

def describe(
    df: DataFrame, columns: Sequence[str] | None = None, cfg: QualityConfig = DEFAULTS, approximate: bool = False
) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per numeric column.

    With ``approximate`` the quartiles are values of the columns whose ranks are close,
    from sketches taken in the pass that counts: one scan in all.
    """
    names = list(columns) if columns is not None else columns_of_class(df, NUMERIC, among=chart_columns(df, cfg))
    clean = nan_to_null(df.select(*[col(c) for c in names]))
    aggs = [
        f"{fn}(CAST({ident(c)} AS DOUBLE)) AS `{i}_{m}`"
        for i, c in enumerate(names)
        for m, fn in (("count", "count"), ("mean", "avg"), ("std", "stddev_samp"), ("min", "min"), ("max", "max"))
    ]
    if approximate:
        aggs += [f"kll_sketch_agg_double(CAST({ident(c)} AS DOUBLE), {K}) AS `{i}_quantile_sketch`" for i, c in enumerate(names)]
        found = one_row_to_long(clean.selectExpr(*aggs), names, ["count", "mean", "std", "min", "max", "quantile_sketch"])
        quartiles = [quantile_at(p, "count").alias(n) for p, n in zip(_QUARTILES, ("p25", "p50", "p75"))]
        return found.select("column", "count", "mean", "std", "min", *quartiles, "max")
    moments = one_row_to_long(clean.selectExpr(*aggs), names, ["count", "mean", "std", "min", "max"])
    at = quantiles(clean, names, _QUARTILES, (), cfg).groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in zip(_QUARTILES, ("p25", "p50", "p75"))]
    )
    # one row per column on either side
    return moments.join(F.broadcast(at), "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def value_counts(df: DataFrame, column: str, k: int | None = 10) -> DataFrame:
    """The k most frequent values, ties in value order; all of them without k."""
    counts = df.where(col(column).isNotNull()).groupBy(col(column).alias("value")).agg(F.count("*").alias("n"))
    return counts if k is None else counts.orderBy(F.desc("n"), "value").limit(k)


def text_value_counts(df: DataFrame, cfg: QualityConfig = DEFAULTS, first: int = 5, k: int = 10) -> DataFrame:
    """Top values of the first few text columns, one shuffle for all of them."""
    names = columns_of_class(df, TEXT, among=chart_columns(df, cfg))[:first]
    long = (
        df.unpivot([], [col(c) for c in names], "column", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    w = W.partitionBy("column").orderBy(F.desc("n"), "value")
    return long.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def grouped_sum(df: DataFrame, x: str, y: str) -> DataFrame:
    """Height of the stacked bar of each x."""
    return df.groupBy(col(x).alias(x)).agg(F.sum(col(y)).alias("total"))


def category_share(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Share of each of the top categories among the categories shown."""
    # the window runs over the k rows that are left
    top = value_counts(df, column, k)
    return top.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy()))


# -- relations between columns -----------------------------------------------

def _facts(clean: DataFrame, names: Sequence[str]) -> Row:
    """Rows, and of each column the values there are, their mean and whether they vary."""
    return clean.selectExpr(
        "count(*) AS rows",
        *[
            f"{e} AS {k}{i}"
            for i, c in enumerate(map(ident, names))
            for k, e in (("n", f"count({c})"), ("m", f"avg({c})"), ("v", f"min({c}) < max({c})"))
        ],
    ).first()


def correlation_pairs(
    df: DataFrame, columns: Sequence[str] | None = None, cfg: QualityConfig = DEFAULTS, facts: Row | None = None
) -> DataFrame:
    """Pearson correlation of each pair of numeric columns, over rows holding both.

    Columns without gaps are centred on their means first; a pair then costs
    one sum of products, which keeps the generated code small and is accurate.
    Pairs with a gap have means of their own and use the running-moment
    aggregates.  A constant column has no correlation (NULL).  ``facts`` are the
    columns' counts and means where the caller has them already.
    """
    names = list(columns) if columns is not None else columns_of_class(df, NUMERIC, among=chart_columns(df, cfg))
    clean = nan_to_null(df.select(*[col(c).cast("double").alias(c) for c in names]))
    pairs = list(combinations(names, 2))
    if not pairs:
        raise ValueError("correlation needs two numeric columns")
    first = facts if facts is not None else _facts(clean, names)
    at = {c: i for i, c in enumerate(names)}
    full = {c for c in names if first["rows"] and first[f"n{at[c]}"] == first["rows"]}
    centred = clean.selectExpr(
        *[f"{ident(c)} - {number(first[f'm{at[c]}'])} AS {ident(c)}" if c in full else ident(c) for c in names]
    )
    parts = []
    for start in range(0, len(pairs), cfg.max_aggs_per_job):
        chunk = pairs[start : start + cfg.max_aggs_per_job]
        aggs: dict[str, str] = {}
        entries = []
        for i, (a, b) in enumerate(chunk):
            x, y = ident(a), ident(b)
            if a in full and b in full:
                sx, sy = f"v_{at[a]}", f"v_{at[b]}"
                aggs |= {sx: f"sum({x} * {x})", sy: f"sum({y} * {y})", f"c_{i}": f"sum({x} * {y})"}
                varies = "true" if first[f"v{at[a]}"] and first[f"v{at[b]}"] else "false"
            else:
                sx, sy = f"x_{i}", f"y_{i}"
                aggs |= {sx: f"regr_sxx({y}, {x})", sy: f"regr_syy({y}, {x})", f"c_{i}": f"regr_sxy({y}, {x})"}
                varies = "true"
            r = f"CASE WHEN {varies} THEN try_divide(c_{i}, sqrt({sx}) * sqrt({sy})) END"
            entries.append(f"named_struct('var_x', {text(a)}, 'var_y', {text(b)}, 'corr', {r})")
        sums = centred.selectExpr(*[f"{e} AS {n}" for n, e in aggs.items()])
        parts.append(sums.selectExpr(f"inline(array({', '.join(entries)}))"))
    return reduce(DataFrame.unionAll, parts)


def correlation_matrix(
    df: DataFrame, columns: Sequence[str] | None = None, cfg: QualityConfig = DEFAULTS
) -> DataFrame:
    """The full symmetric matrix in long form, diagonal included."""
    names = list(columns) if columns is not None else columns_of_class(df, NUMERIC, among=chart_columns(df, cfg))
    clean = nan_to_null(df.select(*[col(c).cast("double").alias(c) for c in names]))
    facts = _facts(clean, names)
    pairs = correlation_pairs(df, names, cfg, facts)
    # the diagonal is 1 unless the column is constant or empty
    ones = [f"named_struct('var_x', {text(c)}, 'var_y', {text(c)}, 'corr', {'1D' if facts[f'v{i}'] else 'CAST(NULL AS DOUBLE)'})" for i, c in enumerate(names)]
    diagonal = df.sparkSession.range(1).selectExpr(f"inline(array({', '.join(ones)}))")
    both = F.inline(
        F.array(
            F.struct(F.col("var_x"), F.col("var_y"), F.col("corr")),
            F.struct(F.col("var_y").alias("var_x"), F.col("var_x").alias("var_y"), F.col("corr")),
        )
    )
    return pairs.select(both).unionByName(diagonal)


def linear_trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line of y on x over rows that hold both, with the range of x."""
    clean = nan_to_null(df.select(col(x).cast("double").alias("x"), col(y).cast("double").alias("y")))
    return clean.agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
    )


def trend_line(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """Evenly spaced points on the trend line, from the least to the greatest x."""
    step = (F.col("x_max") - F.col("x_min")) / (points - 1)
    spread = linear_trend(df, x, y).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    at = F.col("x_min") + step * F.col("point")
    return spread.select("point", at.alias("x"), (F.col("slope") * at + F.col("intercept")).alias("y"))


def scatter_points(
    df: DataFrame, x: str, y: str, color: str | None = None, hover: int = 3
) -> DataFrame:
    """All points with their colour group and the first few other columns."""
    used = [c for c in (x, y, color) if c]
    others = [c for c in df.columns if c not in used][:hover]
    return df.select(*[col(c) for c in [*used, *others]])


# -- distributions -----------------------------------------------------------

def _bin_of(value: Column, lo: float, hi: float, bins: int) -> Column:
    if lo == hi:
        return F.when(value.isNotNull(), F.lit(1).cast("bigint"))
    return F.least(F.width_bucket(value, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins).cast("bigint"))


def _finite(df: DataFrame) -> DataFrame:
    """``v`` where it is a number on the line: neither missing nor infinite."""
    return nan_to_null(df).where("v > double('-Infinity') AND v < double('Infinity')")


def _extent(df: DataFrame, column: str) -> tuple[float, float] | None:
    row = _finite(df.select(col(column).cast("double").alias("v"))).agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    return None if row["lo"] is None else (row["lo"], row["hi"])


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins with their edges and counts, empty bins included.

    Bins cover the finite values.  Infinite ones, if any, are counted apart: bin 0
    for the negative, the one after the last for the positive, with no outer edge.
    """
    every = nan_to_null(df.select(col(column).cast("double").alias("v")))
    value = _finite(every)
    extent = _extent(df, column)
    if extent is None:
        bins, extent = 0, (0.0, 0.0)
    lo, hi = extent
    bins = min(bins, 1) if lo == hi else bins
    width = (hi - lo) / bins if bins else 0.0
    counts = value.where("v IS NOT NULL").groupBy(_bin_of(F.col("v"), lo, hi, max(bins, 1)).alias("bin")).agg(F.count("*").alias("n"))
    frame = df.sparkSession.range(1, bins + 1).select(F.col("id").alias("bin"))
    # both sides have at most one row per bin
    filled = frame.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.lit(lo) + F.lit(width) * (F.col("bin") - 1)).alias("lower"),
        (F.lit(lo) + F.lit(width) * F.col("bin")).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
    low = F.col("v") < 0
    far = every.where("v IN (double('-Infinity'), double('Infinity'))").groupBy(
        F.when(low, 0).otherwise(bins + 1).cast("bigint").alias("bin"),
        F.when(low, float("-inf")).otherwise(hi).alias("lower"),
        F.when(low, lo).otherwise(float("inf")).alias("upper"),
    ).agg(F.count("*").alias("n"))
    return filled.unionAll(far)


def box_stats(df: DataFrame, columns: Sequence[str], cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Quartiles, whiskers at the fences' innermost values, number of outliers."""
    names = list(columns)
    clean = nan_to_null(df.select(*[col(c) for c in names]))
    found = quantile_values(clean, names, _QUARTILES, cfg)
    aggs = []
    for i, (n, (q1, q2, q3)) in enumerate(found.items()):
        v = f"CAST({ident(n)} AS DOUBLE)"
        if q1 is None:  # no value: n is 0 and the rest is NULL
            aggs += [f"count({v}) AS `{i}_n`", f"count({v}) AS `{i}_outliers`"]
            aggs += [f"CAST(NULL AS DOUBLE) AS `{i}_{k}`" for k in ("q1", "median", "q3", "whisker_low", "whisker_high")]
            continue
        reach = cfg.outlier_iqr * (q3 - q1)
        inside = f"{v} BETWEEN {number(q1 - reach)} AND {number(q3 + reach)}"
        aggs += [
            f"count({v}) AS `{i}_n`",
            f"{number(q1)} AS `{i}_q1`", f"{number(q2)} AS `{i}_median`", f"{number(q3)} AS `{i}_q3`",
            f"min(CASE WHEN {inside} THEN {v} END) AS `{i}_whisker_low`",
            f"max(CASE WHEN {inside} THEN {v} END) AS `{i}_whisker_high`",
            f"count_if(NOT ({inside})) AS `{i}_outliers`",
        ]
    fields = ["n", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers"]
    return one_row_to_long(clean.selectExpr(*aggs), list(found), fields)


def box_outliers(df: DataFrame, column: str, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """The rows drawn as single points: all values beyond the fences."""
    clean = nan_to_null(df)
    q1, q3 = quantile_values(clean, [column], (0.25, 0.75), cfg)[column]
    if q1 is None:
        return clean.limit(0)
    reach = cfg.outlier_iqr * (q3 - q1)
    return clean.where((col(column) < F.lit(q1 - reach)) | (col(column) > F.lit(q3 + reach)))


def violin_box(df: DataFrame, column: str, by: str, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Quartiles of a column per group."""
    clean = nan_to_null(df.select(col(by), col(column)))
    return (
        quantiles(clean, [column], _QUARTILES, [by], cfg)
        .groupBy(col(by))
        .agg(*[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in zip(_QUARTILES, ("q1", "median", "q3"))])
    )


def violin_density(df: DataFrame, column: str, by: str | None = None, bins: int = 30) -> DataFrame:
    """Binned density per group on one grid over the whole column.

    The normalising window sees at most one row per bin of a group.
    """
    group = col(by) if by else F.lit("all")
    extent = _extent(df, column) or (0.0, 0.0)
    lo, hi = extent
    width = (hi - lo) / bins if hi > lo else 1.0
    binned = _finite(df.select(group.alias("group"), col(column).cast("double").alias("v")))
    counts = binned.groupBy("group", _bin_of(F.col("v"), lo, hi, bins).alias("bin")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(W.partitionBy("group"))
    return counts.withColumn("density", F.col("n") / (total * F.lit(width)))


def pivot_mean(df: DataFrame, x: str, y: str, value: str, x_values: Sequence[object] | None = None) -> DataFrame:
    """Mean of a value per (y, x): long form, or one column per given x value.

    The wide form needs the x values named, which bounds its width.
    """
    clean = nan_to_null(df)
    if x_values is None:
        return (
            clean.where(col(x).isNotNull() & col(y).isNotNull())
            .groupBy(col(y), col(x))
            .agg(F.avg(col(value)).alias("mean_value"))
            .where("mean_value IS NOT NULL")
        )
    return clean.where(col(y).isNotNull()).groupBy(col(y)).pivot(x, list(x_values)).agg(F.avg(col(value)))


def multi_series(df: DataFrame, x: str, series: Sequence[str]) -> DataFrame:
    """Several columns over one axis, as one long table."""
    wide = df.select(col(x), *[col(c).cast("double").alias(c) for c in series])
    return wide.unpivot([col(x)], [col(c) for c in series], "series", "value")


# -- time --------------------------------------------------------------------

def time_series(
    df: DataFrame, date: str, value: str, bucket: str | None = None, ordered: bool = True
) -> DataFrame:
    """Values in date order; with a bucket, their mean per truncated date."""
    if bucket:
        points = df.groupBy(F.date_trunc(bucket, col(date)).cast("timestamp_ntz").alias("bucket")).agg(
            F.avg(col(value)).alias("mean_value"), F.count(col(value)).alias("n")
        )
        return points.orderBy("bucket") if ordered else points
    points = df.select(col(date), col(value))
    return points.orderBy(col(date), col(value)) if ordered else points


def period_summary(df: DataFrame, date: str, value: str, period: str = "day") -> DataFrame:
    """Rows, total and mean per day or week."""
    return df.groupBy(F.date_trunc(period, col(date)).cast("timestamp_ntz").alias("period")).agg(
        F.count("*").alias("n"), F.sum(col(value)).alias("total"), F.avg(col(value)).alias("mean_value")
    )


def recent(
    df: DataFrame,
    window: str,
    now: datetime | str | None = None,
    column: str = "cleaned_at",
    fallback_to_all: bool = True,
) -> DataFrame:
    """Rows of the last hour, six hours, day or week; all rows when none qualifies.

    A name that is not a known window, or a table without the column, filters
    nothing.
    """
    hours = RECENCY_HOURS.get(window)
    if hours is None or column not in df.columns:
        return df
    since = instant(now) - F.expr(f"INTERVAL {hours} HOURS")
    kept = df.where(col(column).cast("timestamp_ntz") >= since)
    if fallback_to_all and kept.isEmpty():
        return df
    return kept


def retained(
    df: DataFrame, now: datetime | str | None = None, column: str = "ingested_at", cfg: QualityConfig = DEFAULTS
) -> DataFrame:
    """Rows still inside the retention period."""
    since = instant(now) - F.expr(f"INTERVAL {cfg.retention_days} DAYS")
    return df.where(col(column) >= since)


def row_slice(
    df: DataFrame, order_by: Sequence[str], start: int, count: int, columns: Sequence[str] = (), in_memory: int = _OFFSET_IN_MEMORY
) -> DataFrame:
    """Rows ``start`` to ``start + count`` in a total order, some or all columns.

    A shallow offset is a top-k.  A deep one would make that top-k hold every
    skipped row, so the rows are range-partitioned and staged, the partitions
    that hold the slice are found from their sizes, and only those are ranked.
    """
    chosen = [col(c) for c in (columns or df.columns)]
    if start + count <= in_memory:
        return df.orderBy(*order_by).offset(start).limit(count).select(*chosen)
    ranged = stage(df.repartitionByRange(*order_by).withColumn("_part", F.spark_partition_id()), "slice")
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("n"))  # one row per partition
    upto = F.sum("n").over(W.orderBy("_part"))
    offsets = (
        sizes.withColumn("_before", upto - F.col("n"))
        .where((F.col("_before") < start + count) & (F.col("_before") + F.col("n") > start))
        .select("_part", "_before")
    )
    place = F.col("_before") + F.row_number().over(W.partitionBy("_part").orderBy(*order_by)) - 1
    return (
        ranged.join(F.broadcast(offsets), "_part")
        .withColumn("_place", place)
        .where((F.col("_place") >= start) & (F.col("_place") < start + count))
        .orderBy("_place")
        .select(*chosen)
    )


# -- dashboard figures -------------------------------------------------------

def overview(
    df: DataFrame, overall_score: DataFrame | Column | float | None = None, now: datetime | str | None = None,
    cleaned_at: str = "cleaned_at",
) -> DataFrame:
    """Rows, columns, quality score and hours since the newest cleaning.

    The score may be a report, one row with ``overall_score``, as ``assess`` makes it or as the
    summary sink holds it; without a row the score is NULL.
    """
    if isinstance(overall_score, DataFrame):
        overall_score = overall_score.select("overall_score").scalar()
    latest = F.max(col(cleaned_at).cast("timestamp_ntz")) if cleaned_at in df.columns else F.lit(None).cast("timestamp_ntz")
    score = overall_score if isinstance(overall_score, Column) else F.lit(overall_score).cast("double")
    age = F.timestamp_diff("MICROSECOND", F.col("latest"), instant(now)) / F.lit(3_600_000_000.0)
    return df.agg(F.count("*").alias("total_rows"), latest.alias("latest")).select(
        "total_rows",
        F.lit(len(df.columns)).alias("total_columns"),
        score.alias("quality_score"),
        age.alias("data_age_hours"),
    )


def quality_band(score: Column) -> Column:
    # The lower ends of the two better bands.
    return F.when(score >= 80, "normal").when(score >= 60, "warning").otherwise("error")


def quality_bands(scores: DataFrame) -> DataFrame:
    """The four scores with their display band, long form."""
    parts = ("completeness", "uniqueness", "consistency", "validity")
    return scores.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(p).alias("metric"),
                        F.col(f"{p}_score").cast("double").alias("score"),
                        quality_band(F.col(f"{p}_score")).alias("band"),
                    )
                    for p in parts
                ]
            )
        )
    )


def profiling_card(df: DataFrame, column: str, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Type and counts of one column, its most common value or its mean and deviation."""
    one = df.select(col(column))
    kind = type_class(one.schema.fields[0].dataType)
    common = most_common(one, column) if kind == TEXT else None
    return column_profiles(one, cfg).select(
        "column", "data_type", "total_count", "non_null_count", "null_count", "unique_values",
        F.lit(common).cast("string").alias("most_common"),
        F.round("mean_value", 2).alias("mean_value"),
        F.round("std_deviation", 2).alias("std_deviation"),
    )


def column_detail(df: DataFrame, column: str, cfg: QualityConfig = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """The explorer's two panels: counts, and top values or a description."""
    one = df.select(col(column))
    basics = column_profiles(one, cfg).select("column", "data_type", "non_null_count", "null_count", "unique_values")
    if type_class(one.schema.fields[0].dataType) == NUMERIC:
        return basics, describe(one, [column], cfg)
    return basics, value_counts(one, column, 10)


def type_counts(df: DataFrame) -> DataFrame:
    """How many columns there are of each type, with the table's shape.

    The scan only counts rows; types come from the schema.
    """
    tally: dict[str, int] = {}
    for f in df.schema.fields:
        tally[f.dataType.simpleString()] = tally.get(f.dataType.simpleString(), 0) + 1
    entries = [F.struct(F.lit(t).alias("data_type"), F.lit(n).alias("columns")) for t, n in tally.items()]
    return df.agg(F.count("*").alias("total_rows")).select(F.inline(F.array(*entries)), "total_rows")


def data_only(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """The table without its metadata columns."""
    return df.select(*[col(c) for c in data_columns(df, cfg)])


def by_class(df: DataFrame, *classes: str) -> DataFrame:
    return df.select(*[col(c) for c in columns_of_class(df, *classes)])


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Lift struct fields to columns, at any depth; arrays and maps become JSON text."""

    def leaves(data_type: T.StructType, path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in data_type.fields:
            here = (*path, f.name)
            column = reduce(lambda c, part: c.getField(part), here[1:], col(here[0]))
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, here)
            elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
                out.append(F.to_json(column).alias(sep.join(here)))
            else:
                out.append(column.alias(sep.join(here)))
        return out

    return df.select(*leaves(df.schema, ()))


def top_rows(df: DataFrame, by: Sequence[str], tie: Sequence[str], k: int) -> DataFrame:
    """The k rows with the greatest values, ties in the order of further columns."""
    return df.orderBy(*[F.desc(c) for c in by], *[F.asc(c) for c in tie]).limit(k)
