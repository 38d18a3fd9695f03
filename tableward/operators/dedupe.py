"""Duplicate rows: drop, flag, count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import col, compact_key, data_columns


def _keys(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [F.expr(f"{compact_key(c, types[c])} AS _k{i}") for i, c in enumerate(columns)]


def drop_duplicates(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order_by: Sequence[str] = (),
    cfg: QualityConfig = DEFAULTS,
) -> DataFrame:
    """One row per distinct combination of the data columns.

    With ``order_by`` the first row in that order is kept.  Both forms are
    aggregates, so repeats collapse on the map side: a combination that makes
    up a third of the table reaches its reducer as one row per map task.
    """
    names = list(columns) if columns is not None else (data_columns(df, cfg) or df.columns)
    if not names:
        return df
    if not order_by:
        kinds = {f.name: f.dataType for f in df.schema.fields}
        if not any(isinstance(kinds[c], (T.MapType, T.VariantType)) for c in names):
            return df.dropDuplicates(names)
        any_row = F.any_value(F.struct(*[col(c) for c in df.columns])).alias("_first")
        return df.groupBy(*_keys(df, names)).agg(any_row).select("_first.*")
    # Only the order is compared: other columns may be maps.  Ties go by a digest of the row.
    kinds = {f.name: f.dataType for f in df.schema.fields}
    whole = F.sha2(F.to_json(F.struct(*[col(c) for c in df.columns if not isinstance(kinds[c], T.VariantType)])), 256)
    row, order = F.struct(*[col(c) for c in df.columns]), F.struct(*[col(c) for c in order_by], whole.alias("_whole"))
    first = F.min_by(row, order).alias("_first")
    return df.groupBy(*_keys(df, names)).agg(first).select("_first.*")


def flag_duplicates(
    df: DataFrame, order_by: Sequence[str], columns: Sequence[str] | None = None, cfg: QualityConfig = DEFAULTS
) -> DataFrame:
    """Mark every row but the first of its group, keeping all rows.

    The first row of each group comes from a map-side-combined aggregate and is
    joined back by the order columns, which must identify a row; as one struct
    they also match where they hold NULL.  No group is ever gathered in one
    task as a full ranking would do.
    """
    names = list(columns) if columns is not None else (data_columns(df, cfg) or df.columns)
    firsts = (
        df.groupBy(*_keys(df, names))
        .agg(F.min(F.struct(*[col(c) for c in order_by])).alias("_first"))
        .select("_first", F.lit(False).alias("is_duplicate"))
    )
    marked = df.withColumn("_first", F.struct(*[col(c) for c in order_by])).join(firsts, "_first", "left")
    return marked.select(*[col(c) for c in df.columns], F.coalesce("is_duplicate", F.lit(True)).alias("is_duplicate"))


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """First row per key in a total order, as a ranking window.

    Spark prunes each map task's groups to their first row before the shuffle
    (window group limit), so a hot key costs one row per map task.
    """
    w = W.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")
