"""Sinks and the scans that read them back."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.functions.columns import col
from tableward.sources.manifest import children
from tableward.sources.snapshots import current, publish


def dataset_path(root: str, stage: str, dataset: str) -> str:
    return f"{root}/{stage}/dataset={dataset}"


def _storable(df: DataFrame) -> DataFrame:
    """Untyped all-null columns become text, which every format can hold."""
    return df.select(
        *[col(f.name).cast("string").alias(f.name) if isinstance(f.dataType, T.NullType) else col(f.name) for f in df.schema.fields]
    )


def write_raw(df: DataFrame, root: str, dataset: str, by_file: str = "source_file") -> str:
    """Raw rows as Parquet, one folder per schema and file.

    A file that comes again with the same columns replaces its rows; one that
    comes with other columns lands beside them and wins when read.
    """
    rows = _storable(df)
    layout = hashlib.md5(rows.drop(by_file).schema.json().encode()).hexdigest()[:12]
    path = dataset_path(root, "raw", dataset)
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by_file)
        .parquet(f"{path}/layout={layout}")
    )
    return path


def union_widened(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column of differing types becomes double or text."""
    kinds: dict[str, list[T.DataType]] = {}
    for frame in frames:
        for f in frame.schema.fields:
            kinds.setdefault(f.name, []).append(f.dataType)

    def common(types: list[T.DataType]) -> T.DataType | None:
        if len({t.simpleString() for t in types}) == 1:
            return None
        return T.DoubleType() if all(isinstance(t, T.NumericType) for t in types) else T.StringType()

    targets = {name: common(types) for name, types in kinds.items()}
    cast = [
        f.select(*[col(c) if targets[c] is None else col(c).cast(targets[c]).alias(c) for c in f.columns])
        for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def read_raw(spark: SparkSession, root: str, dataset: str, by_file: str = "source_file") -> DataFrame:
    """A dataset's raw rows, of each file the version ingested last."""
    base = dataset_path(root, "raw", dataset)
    layouts = [p for p in children(spark, base) if "/layout=" in p]
    reader = spark.read.option("basePath", base)
    frames = [
        reader.parquet(p).drop("layout").withColumn(by_file, col(by_file).cast("string")) for p in layouts
    ]
    if len(frames) == 1:
        return frames[0]
    rows = union_widened(frames)
    # one row per file
    newest = rows.groupBy(by_file).agg(F.max("ingested_at").alias("ingested_at"))
    return rows.join(newest, [by_file, "ingested_at"], "left_semi")


def write_cleaned(df: DataFrame, root: str, dataset: str) -> str:
    """The next version of the cleaned table; readers of the one before are not disturbed."""
    path = dataset_path(root, "cleaned", dataset)
    publish(_storable(df), path)
    return path


def read_cleaned(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    return spark.read.parquet(current(spark, dataset_path(root, "cleaned", dataset)))


def read_cleaned_csv(spark: SparkSession, path: str, stamps: tuple[str, ...] = ("ingested_at", "cleaned_at")) -> DataFrame:
    """Cleaned data exported as CSV, with its two time stamps restored."""
    df = spark.read.option("header", "true").option("inferSchema", "true").csv(path)
    return df.withColumns({c: col(c).cast("string").try_cast("timestamp_ntz") for c in stamps if c in df.columns})


def write_summary(summary: DataFrame, root: str, dataset: str) -> str:
    path = dataset_path(root, "summary", dataset)
    publish(summary.coalesce(1), path, "json")
    return path


def read_summary(spark: SparkSession, root: str, dataset: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(current(spark, dataset_path(root, "summary", dataset)))


def export_csv(df: DataFrame, path: str) -> None:
    """Header and comma; nested columns as JSON text."""
    df = _storable(df)
    flat = df.select(
        *[
            F.to_json(col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))
            else col(f.name)
            for f in df.schema.fields
        ]
    )
    flat.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def export_name(now: datetime) -> str:
    return f"data_export_{now:%Y%m%d_%H%M%S}.csv"
