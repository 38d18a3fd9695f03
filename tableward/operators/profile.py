"""Column counters: everything one pass can say about each column."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import NUMERIC, TEXT, compact_key, ident, text, type_class


def one_row_to_long(df: DataFrame, columns: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Turn a one-row aggregate with fields ``<position>_<metric>`` into a row per column."""
    rows = [
        f"named_struct('column', {text(name)}, " + ", ".join(f"'{m}', `{i}_{m}`" for m in metrics) + ")"
        for i, name in enumerate(columns)
    ]
    return df.selectExpr(f"inline(array({', '.join(rows)}))")


@dataclass(frozen=True)
class Measure:
    """A named aggregate; ``build(column name, column as SQL, type class)`` gives its SQL."""

    name: str
    build: Callable[[str, str, str], str]


def _only(kind: str, template: str, as_type: str) -> Callable[[str, str, str], str]:
    return lambda name, c, k: template.format(c=c) if k == kind else f"CAST(NULL AS {as_type})"


BASE = (
    Measure("total_count", lambda name, c, k: "count(*)"),
    Measure("non_null_count", lambda name, c, k: f"count({c})"),
)
NUMBERS = (
    Measure("min_value", _only(NUMERIC, "CAST(min({c}) AS DOUBLE)", "DOUBLE")),
    Measure("max_value", _only(NUMERIC, "CAST(max({c}) AS DOUBLE)", "DOUBLE")),
    Measure("mean_value", _only(NUMERIC, "avg(CAST({c} AS DOUBLE))", "DOUBLE")),
    Measure("std_deviation", _only(NUMERIC, "stddev_samp(CAST({c} AS DOUBLE))", "DOUBLE")),
)
LENGTHS = (
    Measure("avg_length", _only(TEXT, "avg(char_length({c}))", "DOUBLE")),
    Measure("min_length", _only(TEXT, "CAST(min(char_length({c})) AS BIGINT)", "BIGINT")),
    Measure("max_length", _only(TEXT, "CAST(max(char_length({c})) AS BIGINT)", "BIGINT")),
)


def measure(
    df: DataFrame,
    columns: Sequence[str],
    measures: Sequence[Measure] = BASE,
    cfg: QualityConfig = DEFAULTS,
) -> DataFrame:
    """One row per column; a single scan unless the table is very wide."""
    kinds = {f.name: type_class(f.dataType) for f in df.schema.fields}
    per_job = max(1, cfg.max_aggs_per_job // len(measures))
    parts = []
    for start in range(0, len(columns), per_job):
        chunk = columns[start : start + per_job]
        aggs = [
            f"{m.build(name, ident(name), kinds[name])} AS `{i}_{m.name}`"
            for i, name in enumerate(chunk)
            for m in measures
        ]
        parts.append(one_row_to_long(df.selectExpr(*aggs), chunk, [m.name for m in measures]))
    return reduce(DataFrame.unionAll, parts)


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column, unique_values`` for all columns.

    Counting distincts side by side makes Spark multiply rows by columns and
    carry every column through.  Here the columns of one type are stacked: one
    shuffle per type, typed keys, repeated values collapsed on the map side.
    """
    by_type: dict[str, list[tuple[str, str]]] = {}
    for f in df.schema.fields:
        if f.name in columns:
            key = compact_key(f.name, f.dataType)
            if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
                kind = "BIGINT"
            elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
                kind = "DOUBLE"
            elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
                kind = f.dataType.simpleString()
            else:
                kind = "STRING"
            by_type.setdefault(kind, []).append((f.name, f"CAST({key} AS {kind})"))
    parts = []
    for members in by_type.values():
        cells = ", ".join(f"named_struct('slot', {i}, 'value', {key})" for i, (_, key) in enumerate(members))
        names = ", ".join(text(n) for n, _ in members)
        parts.append(
            df.selectExpr(f"inline(array({cells}))")
            .where("value IS NOT NULL")
            .distinct()
            .groupBy("slot")
            .count()
            .selectExpr(f"element_at(array({names}), slot + 1) AS column", "count AS unique_values")
        )
    return reduce(DataFrame.unionAll, parts)


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``distinct_rows``: how many different rows there are over the given columns."""
    types = {f.name: f.dataType for f in df.schema.fields}
    keys = df.selectExpr(*[f"{compact_key(c, types[c])} AS {ident(c)}" for c in columns])
    return keys.distinct().agg(F.count("*").alias("distinct_rows"))
