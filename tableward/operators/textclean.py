"""Text tidying and type inference on text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import TEXT, col, columns_of_class, data_columns, ident, text
from tableward.functions.scalars import INTEGER_SHAPE, datetime_or_null, datetime_sql, number_or_null, number_sql, tidy_text

_PROBE_ROWS = 1000


def clean_text(
    df: DataFrame, cfg: QualityConfig = DEFAULTS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Strip, replace blanks, lower-case every text data column."""
    names = columns_of_class(df, TEXT, among=columns if columns is not None else data_columns(df, cfg))
    return df.withColumns({c: tidy_text(col(c), cfg.text_fill) for c in names}) if names else df


def datetime_formats(
    df: DataFrame, columns: Sequence[str], cfg: QualityConfig = DEFAULTS
) -> dict[str, tuple[str, str]]:
    """The first format, if any, in which every value of a column parses.

    One failing value rules a format out, so a handful of rows removes nearly
    all candidates; what is left is verified on the whole table in one pass.
    """

    def agreeing(frame: DataFrame, pairs: list[tuple[str, tuple[str, str]]]) -> list[tuple[str, tuple[str, str]]]:
        if not pairs:
            return []
        names = list(dict.fromkeys(c for c, _ in pairs))
        row = frame.selectExpr(
            *[f"count({ident(c)}) AS n{i}" for i, c in enumerate(names)],
            *[f"count({datetime_sql(ident(c), *f)}) AS p{i}" for i, (c, f) in enumerate(pairs)],
        ).first()
        held = {c: row[f"n{i}"] for i, c in enumerate(names)}
        return [pair for i, pair in enumerate(pairs) if row[f"p{i}"] == held[pair[0]]]

    if not columns:
        return {}
    narrow = df.select(*[col(c) for c in columns])
    pairs = [(c, f) for c in columns for f in cfg.datetime_formats]
    per_job = cfg.max_aggs_per_job // 2
    left: list[tuple[str, tuple[str, str]]] = []
    probe = narrow.limit(_PROBE_ROWS)
    for i in range(0, len(pairs), per_job):
        left += agreeing(probe, pairs[i : i + per_job])
    if not left:
        return {}
    # an all-null column agrees with every format and is no date
    held = narrow.selectExpr(*[f"count({ident(c)}) AS {ident(c)}" for c in dict.fromkeys(c for c, _ in left)]).first()
    left = [(c, f) for c, f in left if held[c]]
    chosen: dict[str, tuple[str, str]] = {}
    for i in range(0, len(left), per_job):
        for c, f in agreeing(narrow, left[i : i + per_job]):
            chosen.setdefault(c, f)
    return chosen


def coerce_datetimes(
    df: DataFrame, cfg: QualityConfig = DEFAULTS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Text columns that are dates throughout become timestamps; others stay as they are."""
    names = columns_of_class(df, TEXT, among=columns if columns is not None else data_columns(df, cfg))
    formats = datetime_formats(df, names, cfg)
    return (
        df.withColumns({c: datetime_or_null(col(c), *f) for c, f in formats.items()}) if formats else df
    )


def numeric_text_columns(df: DataFrame, columns: Sequence[str], cfg: QualityConfig = DEFAULTS) -> list[str]:
    """Text columns in which more than the configured share of rows are numbers."""
    if not columns:
        return []
    row = df.selectExpr(
        "count(*) AS rows", *[f"count({number_sql(ident(c))}) AS n{i}" for i, c in enumerate(columns)]
    ).first()
    return [c for i, c in enumerate(columns) if row["rows"] and row[f"n{i}"] / row["rows"] > cfg.numeric_share]


def coerce_numbers(
    df: DataFrame, cfg: QualityConfig = DEFAULTS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Text columns that are mostly numbers become double; other values become NULL."""
    names = columns_of_class(df, TEXT, among=columns if columns is not None else data_columns(df, cfg))
    chosen = numeric_text_columns(df, names, cfg)
    return df.withColumns({c: number_or_null(col(c)) for c in chosen}) if chosen else df


def infer_types(
    df: DataFrame, cfg: QualityConfig = DEFAULTS, columns: Sequence[str] | None = None
) -> DataFrame:
    """Dates first, then numbers among the columns that are left."""
    dated = coerce_datetimes(df, cfg, columns)
    return coerce_numbers(dated, cfg, columns)


def infer_reader_types(
    df: DataFrame,
    cfg: QualityConfig = DEFAULTS,
    columns: Sequence[str] | None = None,
    drop_empty: bool = False,
) -> DataFrame:
    """Types a text file's columns would get on load: whole numbers, numbers,
    booleans, when every value present fits; otherwise text.

    Whole numbers of which some exceed a bigint stay text: a double would make
    different ones equal.
    """
    names = columns_of_class(df, TEXT, among=columns if columns is not None else data_columns(df, cfg))
    if not names:
        return df
    aggs = []
    for i, c in enumerate(names):
        v = ident(c)
        aggs += [
            f"count({v}) AS n{i}",
            f"count_if({v} RLIKE {text(INTEGER_SHAPE)}) AS i{i}",
            f"count(CASE WHEN {v} RLIKE {text(INTEGER_SHAPE)} THEN try_cast({v} AS BIGINT) END) AS l{i}",
            f"count({number_sql(v)}) AS d{i}",
            f"count_if({v} IN ('true', 'false', 'True', 'False', 'TRUE', 'FALSE')) AS b{i}",
        ]
    row = df.selectExpr(*aggs).first()
    casts, empty = {}, []
    for i, c in enumerate(names):
        n = row[f"n{i}"]
        if not n:
            empty.append(c)
            continue
        if row[f"i{i}"] == n:
            if row[f"l{i}"] == n:
                casts[c] = col(c).try_cast("bigint")
        elif row[f"d{i}"] == n:
            casts[c] = number_or_null(col(c))
        elif row[f"b{i}"] == n:
            casts[c] = col(c).try_cast("boolean")
    typed = df.withColumns(casts) if casts else df
    return typed.drop(*empty) if drop_empty else typed
