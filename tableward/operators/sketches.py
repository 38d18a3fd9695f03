"""Approximate column statistics on request, from sketches that can be stored and merged.

The exact operators stay the default.  A sketch row says all about one column of one
group, in a size that does not depend on the number of rows: how many rows there are, a
HyperLogLog sketch of the distinct values, and for numbers a KLL sketch of the quantiles.
Sketches of single partitions are kept in a table; a new or rewritten partition only
replaces its own rows there, and the statistics of everything are merged from the table.

Distinct counts have a relative standard error of about 1.04 / sqrt(2 ** lg_k).  A
quantile's rank is off by about 2.3 / k ** 0.97 of the rows.  Smallest and greatest values
are exact, and so are the distinct counts of columns with few values.  NaN counts as
missing.  A quantile is a value of the column, without interpolation, and NULL where the
column has no values or no numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import NUMERIC, compact_key, data_columns, ident, nan_to_null, text, type_class

#: Sizes of the sketches.  At these a distinct count is off by 0.8 % and a rank by 0.3 % as a rule.
LG_K, K = 14, 1000
#: Columns sketched by one aggregate, as each has some tens of kilobytes per group while it runs.
COLUMNS = 32
_FIELDS = ("total_count", "non_null_count", "distinct_sketch", "quantile_sketch")


def column_sketches(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    by: Sequence[str] = (),
    cfg: QualityConfig = DEFAULTS,
    lg_k: int = LG_K,
    k: int = K,
) -> DataFrame:
    """``by…, column, total_count, non_null_count, distinct_sketch, quantile_sketch``, a row per group and column.

    The rows are not shuffled: each task sketches what it reads, and only sketches meet.
    Of an empty table there is one row per column without ``by``, none with it.
    """
    names = [c for c in (columns if columns is not None else data_columns(df, cfg)) if c not in by]
    kinds = {f.name: f.dataType for f in df.schema.fields}
    clean = nan_to_null(df)
    keys = [ident(c) for c in by]
    parts = []
    for start in range(0, len(names), COLUMNS):
        chunk = names[start : start + COLUMNS]
        aggs, rows = [], []
        for i, name in enumerate(chunk):
            c, key = ident(name), compact_key(name, kinds[name])
            quantile = f"kll_sketch_agg_double(CAST({c} AS DOUBLE), {k})" if type_class(kinds[name]) == NUMERIC else "CAST(NULL AS BINARY)"
            found = ("count(*)", f"count({c})", f"hll_sketch_agg(CASE WHEN {c} IS NOT NULL THEN xxhash64({key}) END, {lg_k})", quantile)
            aggs += [F.expr(e).alias(f"_{i}_{m}") for e, m in zip(found, _FIELDS)]
            rows.append(f"named_struct('column', {text(name)}, " + ", ".join(f"'{m}', _{i}_{m}" for m in _FIELDS) + ")")
        parts.append(clean.groupBy(*[F.col(c) for c in keys]).agg(*aggs).selectExpr(*keys, f"inline(array({', '.join(rows)}))"))
    return reduce(DataFrame.unionAll, parts)


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The sketches of larger groups, of the whole without ``by``: the same columns, counts added up and sketches merged."""
    return sketches.groupBy(*[F.col(ident(c)) for c in by], "column").agg(
        F.sum("total_count").alias("total_count"),
        F.sum("non_null_count").alias("non_null_count"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        # a column without numbers has no sketch in any group
        F.when(F.count("quantile_sketch") > 0, F.kll_merge_agg_double("quantile_sketch")).alias("quantile_sketch"),
    )


def write_sketches(sketches: DataFrame, path: str, by: Sequence[str]) -> None:
    """Keeps sketches by partition; partitions that come again replace what is kept of them, the others stay."""
    writer = sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def quantile_at(prob: float, count: str = "non_null_count") -> Column:
    """The value at a rank of ``quantile_sketch``, which has seen ``count`` values."""
    known = F.col("quantile_sketch").isNotNull() & (F.col(count) > 0)
    return F.when(known, F.kll_sketch_get_quantile_double("quantile_sketch", F.lit(float(prob))))


def sketch_profile(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``by…, column, total_count, non_null_count, unique_values, uniqueness, min_value, p25, p50, p75, max_value``.

    ``uniqueness`` is the share of distinct values in percent of the values there are, at most 100.
    """
    unique = F.hll_sketch_estimate("distinct_sketch")
    share = F.when(F.col("non_null_count") > 0, F.least(unique * 100.0 / F.col("non_null_count"), F.lit(100.0)))
    at = {"min_value": 0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "max_value": 1}
    return merge_sketches(sketches, by).select(
        *[F.col(ident(c)) for c in by], "column", "total_count", "non_null_count", unique.alias("unique_values"),
        share.alias("uniqueness"), *[quantile_at(p).alias(n) for n, p in at.items()],
    )


def approximate_profile(df: DataFrame, columns: Sequence[str] | None = None, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """``sketch_profile`` of a table in one scan."""
    return sketch_profile(column_sketches(df, columns, (), cfg))
