"""Scalar expressions of the cleaning and display layers.  No Python UDFs."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tableward.config import DEFAULTS, NULL_TOKENS
from tableward.functions.columns import text

# Every character Unicode (and Python's str.strip) treats as blank.
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# What counts as a number in text.  The cast alone is too generous: it reads
# '1d' and 'nan' as doubles.
NUMBER_SHAPE = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
INTEGER_SHAPE = r"^[+-]?\d+$"


def instant_sql(now: datetime | str | None) -> str:
    if now is None:
        return "localtimestamp()"
    return f"TIMESTAMP_NTZ '{now if isinstance(now, str) else now.isoformat(sep=' ')}'"


def instant(now: datetime | str | None) -> Column:
    """A fixed time as a zone-less timestamp, or the query's own start time."""
    return F.expr(instant_sql(now))


def strip(column: Column) -> Column:
    return F.btrim(column, F.lit(WHITESPACE))


def null_if_token(column: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    return F.when(~column.isin(*tokens), column)


def tidy_text(column: Column, fill: str = DEFAULTS.text_fill) -> Column:
    """Strip, name the blanks, lower-case: the three text rules in one expression."""
    stripped = strip(column)
    blank = column.isNull() | stripped.isin("", "nan")
    return F.when(blank, F.lit(fill)).otherwise(F.lower(stripped))


def number_or_null(column: Column) -> Column:
    stripped = strip(column)
    return F.when(stripped.rlike(NUMBER_SHAPE), stripped.try_cast("double"))


def number_sql(column: str) -> str:
    stripped = f"btrim({column}, {text(WHITESPACE)})"
    return f"CASE WHEN {stripped} RLIKE {text(NUMBER_SHAPE)} THEN try_cast({stripped} AS DOUBLE) END"


def datetime_or_null(column: Column, fmt: str, shape: str) -> Column:
    """Parse only what has the right shape: failed parses are far dearer than a regex."""
    return F.when(
        column.rlike(shape),
        F.try_to_timestamp(column, F.lit(fmt)).cast("timestamp_ntz"),
    )


def datetime_sql(column: str, fmt: str, shape: str) -> str:
    return (
        f"CASE WHEN {column} RLIKE {text(shape)} THEN "
        f"CAST(try_to_timestamp({column}, {text(fmt)}) AS TIMESTAMP_NTZ) END"
    )


def one_decimal(value: Column) -> Column:
    """Text with one decimal, rounded from the stored binary value, halves to even.

    The JVM's formatter rounds the shortest decimal text instead, which makes
    1.15 (stored slightly below) 1.2.  Splitting the value in two halves of its
    bits keeps both products exact, so the comparison with the midpoint is too.
    """
    big = value * F.lit(134217729.0)
    high = big - (big - value)
    low = value - high
    tenths = F.floor(value * 10)
    middle = (tenths * 2 + 1).cast("double")
    side = (high * 20 - middle) + low * 20
    up = (side > 0) | ((side == 0) & (tenths % 2 != 0))
    nearest = tenths + F.when(up, F.lit(1)).otherwise(F.lit(0))
    return F.format_string("%.1f", nearest.cast("double") / 10)


def human_number(column: Column) -> Column:
    """1.2M, 3.4K, or the number as it is."""
    as_double = column.cast("double")
    return (
        F.when(as_double >= 1_000_000, F.concat(one_decimal(as_double / 1_000_000), F.lit("M")))
        .when(as_double >= 1_000, F.concat(one_decimal(as_double / 1_000), F.lit("K")))
        .otherwise(column.cast("string"))
    )


def human_bytes(column: Column) -> Column:
    size = column.cast("double")
    # The units, each 1024 of the one before.
    units = ("B", "KB", "MB", "GB", "TB")
    shown = [F.concat(one_decimal(size / 1024**p), F.lit(f" {u}")) for p, u in enumerate(units)]
    out = F.when(size < 1024, shown[0])
    for power in range(1, len(units) - 1):
        out = out.when(size < 1024 ** (power + 1), shown[power])
    return out.otherwise(shown[-1])


def megabytes(column: Column) -> Column:
    return F.round(column / F.lit(1024 * 1024), 2)
