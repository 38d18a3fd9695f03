"""Parameters of the operators, in one immutable object."""

from __future__ import annotations

from dataclasses import dataclass

# Cells that mean "missing" when they match as a whole.
NULL_TOKENS = ("", " ", "NULL", "null", "None", "none", "N/A", "n/a", "NA", "na")

# The null markers the public pandas CSV reader documents.
CSV_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Delimiters looked for in the first line of a text file, in order.
TEXT_DELIMITERS = (";", "\t", "|")

# File extensions with a reader of their own.
READABLE_EXTENSIONS = (".csv", ".json", ".xlsx", ".xls", ".txt")

# Candidate formats for date inference, with the shape a value must have before
# the parser is tried.  Text is lower-cased before inference, hence the 't'.
DATETIME_FORMATS = (
    ("yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$"),
    ("yyyy-MM-dd HH:mm:ss", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"),
    ("yyyy-MM-dd HH:mm:ss.SSSSSS", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{6}$"),
    ("yyyy-MM-dd HH:mm", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$"),
    ("yyyy-MM-dd't'HH:mm:ss", r"^\d{4}-\d{2}-\d{2}t\d{2}:\d{2}:\d{2}$"),
    ("yyyy-MM-dd't'HH:mm:ss.SSSSSS", r"^\d{4}-\d{2}-\d{2}t\d{2}:\d{2}:\d{2}\.\d{6}$"),
    ("yyyy-MM-dd'T'HH:mm:ss", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}$"),
    ("yyyy/MM/dd", r"^\d{4}/\d{2}/\d{2}$"),
    ("MM/dd/yyyy", r"^\d{2}/\d{2}/\d{4}$"),
    ("dd.MM.yyyy", r"^\d{2}\.\d{2}\.\d{4}$"),
)

# Name of a recency window -> hours; None keeps everything.
RECENCY_HOURS = {
    "Last Hour": 1,
    "Last 6 Hours": 6,
    "Last Day": 24,
    "Last Week": 168,
    "All Time": None,
}


@dataclass(frozen=True)
class QualityConfig:
    # quality thresholds, percent
    completeness_min: float = 80.0
    uniqueness_min: float = 95.0
    consistency_min: float = 90.0
    validity_min: float = 85.0

    # columns that describe a row's origin rather than its content
    metadata_cols: tuple[str, ...] = ("ingested_at", "data_source", "source_file")
    # columns the cleaner adds; not data when rows are scored or charts drawn
    indicator_cols: tuple[str, ...] = ("cleaned_at", "completeness_score")

    # cleaning
    null_tokens: tuple[str, ...] = NULL_TOKENS
    text_fill: str = "unknown"
    drop_null_share: float = 0.90
    numeric_share: float = 0.50
    datetime_formats: tuple[tuple[str, str], ...] = DATETIME_FORMATS
    infer_before_impute: bool = False
    outlier_iqr: float = 1.5
    outlier_remove_share: float = 0.05
    outlier_mode: str = "sequential"

    # consistency checks
    extreme_iqr: float = 3.0
    extreme_share: float = 0.05
    mixed_case_share: float = 0.30

    # ingest
    max_file_bytes: int | None = None  # a limit leaves whole files out of the result
    xml_row_tag: str = "row"
    max_file_age_hours: int = 24
    retention_days: int = 30
    ingest_trigger: str = "15 minutes"
    clean_trigger: str = "10 minutes"

    # Exact quantiles: up to this many rows, a window ranks a column's distinct
    # values; above it the distributed search takes over.
    quantile_inline_rows: int = 200_000
    # Aggregate expressions put into a single job before it is split.
    max_aggs_per_job: int = 400


DEFAULTS = QualityConfig()
