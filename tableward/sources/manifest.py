"""File listings as DataFrames.

Spark lists directories on the executors when there are many of them, and the
column pruning of the ``binaryFile`` source means a listing opens no file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.scalars import instant, megabytes

# Content types by extension.
CONTENT_TYPES = {
    ".csv": "text/csv",
    ".json": "application/json",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".xls": "application/vnd.ms-excel",
    ".txt": "text/plain",
    ".xml": "application/xml",
    ".parquet": "application/vnd.apache.parquet",
}
# Which reader an extension goes to; anything else is tried as text.
KINDS = {".csv": "csv", ".json": "json", ".xlsx": "excel", ".xls": "excel", ".xml": "xml"}


def qualified(spark: SparkSession, path: str) -> str:
    """The path as listings show it, with scheme and without a trailing slash."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(target).toString().rstrip("/")


def exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Direct children of a folder; an absent folder has none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(target)) if fs.exists(target) else []


def _choice(column: Column, table: dict[str, str], default: str) -> Column:
    out = F.when(F.lit(False), F.lit(default))
    for key, value in table.items():
        out = out.when(column == key, F.lit(value))
    return out.otherwise(F.lit(default))


def describe_files(files: DataFrame, root: str) -> DataFrame:
    """Manifest columns from ``path, modificationTime, length``."""
    name = F.expr(f"substring(path, {len(root) + 2})")
    extension = F.lower(F.regexp_extract("name", r"(\.[^./]+)$", 1))
    return (
        files.select(
            name.alias("name"),
            "path",
            F.col("length").alias("size"),
            F.col("modificationTime").cast("timestamp_ntz").alias("last_modified"),
        )
        .withColumn("extension", extension)
        .withColumn("content_type", _choice(F.col("extension"), CONTENT_TYPES, "application/octet-stream"))
        .withColumn("kind", _choice(F.col("extension"), KINDS, "text"))
        .withColumn(
            "dataset",
            # a CSV file in the root gives its bare name, another kind keeps its extension: a.csv and a.json stay apart
            F.when(F.contains("name", F.lit("/")), F.substring_index("name", "/", 1))
            .when(F.col("extension") == ".csv", F.regexp_replace("name", r"\.[^.]+$", ""))
            .otherwise(F.col("name")),
        )
    )


def list_files(
    spark: SparkSession, root: str, prefix: str = "", pattern: str | None = None
) -> DataFrame:
    """All files under a root: name, size, modification time, content type."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    base = qualified(spark, root)
    listed = describe_files(reader.load(root).select("path", "modificationTime", "length"), base)
    return listed.where(F.col("name").startswith(prefix)) if prefix else listed


def list_containers(files: DataFrame) -> DataFrame:
    """The first path segments below the root."""
    return (
        files.where(F.contains("name", F.lit("/")))
        .select(F.substring_index("name", "/", 1).alias("container"))
        .distinct()
    )


def read_content(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """File bytes with their checksum; the content stays on the executors."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    base = qualified(spark, root)
    return reader.load(root).select(
        F.expr(f"substring(path, {len(base) + 2})").alias("name"), "content", F.md5("content").alias("etag")
    )


def file_metadata(files: DataFrame, name: str) -> DataFrame:
    return files.where(F.col("name") == name)


def file_exists(files: DataFrame, name: str) -> bool:
    return not file_metadata(files, name).isEmpty()


def container_stats(files: DataFrame) -> DataFrame:
    """Number of objects, total bytes and megabytes."""
    return files.agg(
        F.count("*").alias("object_count"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_size_bytes")
    ).withColumn("total_size_mb", megabytes(F.col("total_size_bytes")))


def split_by_size(files: DataFrame, cfg: QualityConfig = DEFAULTS) -> tuple[DataFrame, DataFrame]:
    """Files to read, and files refused for their size with the reason.

    Without a configured limit nothing is refused.  Only formats read file by file are limited; delimited and plain text is
    split over tasks whatever its size.
    """
    if cfg.max_file_bytes is None:
        return files, files.limit(0).withColumn("error_message", F.lit(None).cast("string"))
    whole = F.col("kind").isin("json", "excel")
    refused = whole & (F.col("size") > cfg.max_file_bytes)
    reason = F.format_string(f"exceeds maximum size limit of {cfg.max_file_bytes} bytes")
    return files.where(~refused), files.where(refused).withColumn("error_message", reason)


def newer_than(files: DataFrame, now=None, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """Files not older than the configured age."""
    since = instant(now) - F.expr(f"INTERVAL {cfg.max_file_age_hours} HOURS")
    return files.where(F.col("last_modified") >= since)


def newest_first(files: DataFrame) -> DataFrame:
    return files.orderBy(F.desc("last_modified"), "name")


def file_info(files: DataFrame) -> DataFrame:
    return files.select("name", "size", megabytes(F.col("size")).alias("size_mb"), F.col("last_modified").alias("modified"))


def parquet_row_counts(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows per Parquet file, whatever the files' schemas: no column is read."""
    blank = spark.read.schema("_none int").option("recursiveFileLookup", "true").parquet(*paths)
    return blank.groupBy(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified"),
    ).agg(F.count("*").alias("rows"))


def catalogue_summary(spark: SparkSession, *paths: str) -> DataFrame:
    """Files, rows and megabytes over all cleaned data, newest and oldest file."""
    order = F.struct("modified", "file")
    return parquet_row_counts(spark, *paths).agg(
        F.count("*").alias("total_files"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        megabytes(F.coalesce(F.sum("size"), F.lit(0))).alias("total_size_mb"),
        F.max_by("file", order).alias("latest_file"),
        F.min_by("file", order).alias("oldest_file"),
        F.max("modified").alias("latest_update"),
    )
