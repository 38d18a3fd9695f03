"""Which columns an operator works on: data or metadata, and of which class."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.config import DEFAULTS, QualityConfig

NUMERIC, TEXT, TEMPORAL, BOOLEAN, OTHER = "numeric", "text", "datetime", "boolean", "other"


def type_class(data_type: T.DataType) -> str:
    if isinstance(data_type, T.NumericType):
        return NUMERIC
    if isinstance(data_type, (T.StringType, T.CharType, T.VarcharType)):
        return TEXT
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return TEMPORAL
    if isinstance(data_type, T.BooleanType):
        return BOOLEAN
    return OTHER


def data_columns(df: DataFrame, cfg: QualityConfig = DEFAULTS, exclude: Iterable[str] = ()) -> list[str]:
    """All columns but metadata (and whatever else is excluded)."""
    skip = set(cfg.metadata_cols) | set(exclude)
    return [name for name in df.columns if name not in skip]


def chart_columns(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> list[str]:
    """Data columns as the exploration layer sees them: no cleaning indicators."""
    return data_columns(df, cfg, exclude=cfg.indicator_cols)


def columns_of_class(df: DataFrame, *classes: str, among: Iterable[str] | None = None) -> list[str]:
    allowed = None if among is None else set(among)
    return [
        f.name
        for f in df.schema.fields
        if type_class(f.dataType) in classes and (allowed is None or f.name in allowed)
    ]


def col(name: str) -> Column:
    """Column by exact name, also when the name holds dots or blanks."""
    return F.col(ident(name))


# Expressions over many columns are written as SQL text: one parsed string per
# expression instead of a driver round trip per operator in it.


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float) -> str:
    if math.isinf(value) or math.isnan(value):
        return f"double('{value}')"
    return f"{float(value)!r}D"


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing: it would otherwise pass IS NOT NULL and poison aggregates."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    return df.selectExpr(
        *[f"nanvl({ident(c)}, NULL) AS {ident(c)}" if c in floats else ident(c) for c in df.columns]
    )


def compact_key(name: str, data_type: T.DataType) -> str:
    """A grouping key, as SQL, equal exactly when the value is equal, of bounded width.

    Long text is replaced by its SHA-256; a digest key is longer than any text
    kept as it is, so the two kinds never meet.  This keeps distinct and
    duplicate shuffles narrow on tables with document-sized cells.
    """
    c = ident(name)
    if type_class(data_type) == TEXT:
        return f"CASE WHEN octet_length({c}) <= 64 THEN {c} ELSE concat('sha256:', sha2({c}, 256)) END"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return f"({c} + 0.0D)"  # folds -0.0 into 0.0
    if isinstance(data_type, T.BinaryType):
        return f"sha2({c}, 256)"
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
        return f"CASE WHEN {c} IS NOT NULL THEN sha2(to_json(struct({c} AS v)), 256) END"
    return c
