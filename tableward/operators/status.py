"""Processing status: an append-only event log and what is derived from it.

``file_status(file, stage, status, ts, error_message)`` has one row per event
of a file, ``cycle_status(stage, status, ts)`` one per run of a stage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.functions.names import summary_name

FILE_STATUS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("error_message", T.StringType()),
    ]
)
CYCLE_STATUS = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)
# The two stages a pipeline status is made of.
STAGES = ("ingest", "clean")


def latest_per_key(log: DataFrame, keys: Sequence[str], ts: str = "ts", tie: Sequence[str] = ("status",)) -> DataFrame:
    """The last event of each key: the last write wins.

    An aggregate, so a key with very many events is reduced on the map side.
    Events of the same instant are ordered by ``tie``.
    """
    rest = [c for c in log.columns if c not in keys]
    lead = [ts, *[t for t in tie if t in rest]]
    order = [*lead, *[c for c in rest if c not in lead]]
    last = F.max(F.struct(*order)).alias("_last")
    return log.groupBy(*keys).agg(last).select(*keys, *[F.col("_last")[c].alias(c) for c in rest])


def new_files(manifest: DataFrame, state: DataFrame) -> DataFrame:
    """Files that are new, or whose modification time differs from the one recorded."""
    return manifest.join(state.select("name", "last_modified"), ["name", "last_modified"], "left_anti")


def unprocessed_files(files: DataFrame, file_status: DataFrame, stage: str = "clean") -> DataFrame:
    """Files whose latest status in a stage is not ``completed``."""
    latest = latest_per_key(file_status.where(F.col("stage") == stage), ["file"])
    done = latest.where("status = 'completed'").select("file")
    return files.join(done, "file", "left_anti")


def pipeline_status(cycle_status: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Latest status of both stages and the overall verdict.

    Healthy when both completed, error when either failed, else warning.
    """
    latest = latest_per_key(cycle_status, [*by, "stage"])
    wide = latest.groupBy(*by).agg(
        *[
            F.max(F.when(F.col("stage") == s, F.col(c))).alias(f"{s}_{n}")
            for s in STAGES
            for c, n in (("status", "status"), ("ts", "last_run"))
        ]
    )
    states = [F.coalesce(f"{s}_status", F.lit("unknown")) for s in STAGES]
    verdict = (
        F.when((states[0] == "completed") & (states[1] == "completed"), "healthy")
        .when((states[0] == "error") | (states[1] == "error"), "error")
        .otherwise("warning")
    )
    return wide.select(
        *by,
        *[state.alias(f"{s}_status") for s, state in zip(STAGES, states)],
        *[f"{s}_last_run" for s in STAGES],
        verdict.alias("overall"),
    )


def timeline(file_status: DataFrame, k: int = 10, stage: str = "clean") -> DataFrame:
    """The latest event of each file, newest first, with a display mark."""
    latest = latest_per_key(file_status.where(F.col("stage") == stage), ["file"])
    mark = (
        F.when(F.col("status") == "completed", "green")
        .when(F.col("status") == "processing", "yellow")
        .when(F.col("status") == "error", "red")
        .otherwise("white")
    )
    return (
        latest.orderBy(F.desc("ts"), "file")
        .limit(k)
        .select(
            "ts",
            F.concat(F.lit("Cleaned "), F.col("file")).alias("event"),
            "status",
            mark.alias("mark"),
            F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("shown_at"),
        )
    )


def events(df: DataFrame, stage: str, status: str, now, file: str = "file", error=None) -> DataFrame:
    """Rows of the file log for the files of a frame."""
    return df.select(
        F.col(file).alias("file"),
        F.lit(stage).alias("stage"),
        F.lit(status).alias("status"),
        now.alias("ts"),
        (F.lit(None) if error is None else error).cast("string").alias("error_message"),
    )


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def pair_reports(catalogue: DataFrame, reports: DataFrame) -> DataFrame:
    """Each cleaned dataset with its report, found by the derived report name."""
    keyed = catalogue.withColumn("report", summary_name(F.col("dataset")))
    return keyed.join(reports, "report", "left")
