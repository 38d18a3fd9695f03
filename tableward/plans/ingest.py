"""Normalisation of freshly read data: lineage, names, null tokens, empty rows and columns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import col
from tableward.functions.names import ingest_names
from tableward.functions.scalars import instant
from tableward.operators.missing import drop_empty_columns, drop_empty_rows, replace_null_tokens


LINEAGE = ("ingested_at", "data_source", "source_file")
# Where a reader notes a row's file.
_CARRIED = ("_source_path",)


def add_lineage(
    df: DataFrame,
    source: str,
    now: datetime | str | None = None,
    file: Column | str | None = None,
) -> DataFrame:
    """When, from where and from which file a row came."""
    added = {"ingested_at": instant(now), "data_source": F.lit(source)}
    if file is not None:
        added["source_file"] = F.lit(file) if isinstance(file, str) else file
    return df.withColumns(added)


def normalise_rows(
    df: DataFrame,
    source: str,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    file: Column | str | None = None,
) -> DataFrame:
    """The row-local part: also applies to a streaming frame.

    Data columns are renamed first and keep clear of the lineage names, so a
    header ``Source File`` becomes ``source_file_1`` and lineage stays what it is.
    ``file`` may read columns of ``df``; those named in ``_CARRIED`` end there.
    """
    carried = [c for c in df.columns if c in _CARRIED]
    data = [c for c in df.columns if c not in _CARRIED]
    names = ingest_names(data, (*LINEAGE, *carried))
    renamed = df.select(*[col(c).alias(n) for c, n in zip(data, names)], *[col(c) for c in carried])
    return (
        add_lineage(renamed, source, now, file)
        .drop(*carried)
        .transform(replace_null_tokens, cfg)
        .transform(drop_empty_rows, cfg)
    )


def normalise(
    df: DataFrame,
    source: str,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    file: Column | str | None = None,
) -> DataFrame:
    """The whole flow; dropping empty columns needs one pass over the data."""
    return normalise_rows(df, source, cfg, now, file).transform(drop_empty_columns, cfg)
