"""Column-name and dataset-name rules.

Two rules exist on purpose: the ingest rule removes punctuation, the cleaning
rule turns separators into underscores.  ``a-b`` is ``ab`` under the first and
``a_b`` under the second.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableward.config import DEFAULTS, QualityConfig


def _unique(names: Iterable[str], taken: Iterable[str] = ()) -> list[str]:
    """Give later holders of a taken name the first free numeric suffix.

    Names that differ in case only count as the same, as they do for Spark.
    """
    names = list(names)
    used = {t.lower() for t in taken}
    reserved = {n.lower() for n in names}
    out = []
    for name in names:
        candidate, n = name, 0
        while candidate.lower() in used or (n and candidate.lower() in reserved):
            n += 1
            candidate = f"{name}_{n}"
        used.add(candidate.lower())
        out.append(candidate)
    return out


def ingest_name(name: str) -> str:
    kept = re.sub(r"[^\w\s]", "", name.strip().lower().replace(" ", "_"))
    return re.sub(r"_{2,}", "_", kept)


def clean_name(name: str, position: int) -> str:
    joined = re.sub(r"[ .\-]", "_", name.lower().strip())
    kept = re.sub(r"\W", "", joined.replace("__", "_"))
    if not kept:
        return f"col_{position}"
    return f"col_{kept}" if kept[0].isdigit() else kept


def ingest_names(names: Iterable[str], taken: Iterable[str] = ()) -> list[str]:
    return _unique((ingest_name(n) or f"col_{i}" for i, n in enumerate(names)), taken)


def clean_names(names: Iterable[str], cfg: QualityConfig = DEFAULTS) -> list[str]:
    return _unique(
        n if n in cfg.metadata_cols else clean_name(n, i) for i, n in enumerate(names)
    )


def rename_for_ingest(df: DataFrame, taken: Iterable[str] = ()) -> DataFrame:
    """Apply the ingest rule; columns that would get a name in ``taken`` get a suffix."""
    return df.toDF(*ingest_names(df.columns, taken))


def rename_for_cleaning(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    return df.toDF(*clean_names(df.columns, cfg))


def raw_name(column: Column) -> Column:
    return F.concat(F.lit("raw_"), column)


def cleaned_name(column: Column) -> Column:
    return F.replace(column, F.lit("raw_"), F.lit("cleaned_"))


def summary_name(column: Column) -> Column:
    """Name of the summary that belongs to a raw or cleaned dataset."""
    swapped = F.regexp_replace(column, r"raw_|cleaned_", "summary_")
    return F.regexp_replace(swapped, r"\.csv", ".json")
