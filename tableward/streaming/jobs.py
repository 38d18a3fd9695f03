"""Ingest and clean cycles, run once, on a schedule, or per micro-batch.

Layout below the lake root: ``raw/dataset=…``, ``cleaned/dataset=…``,
``summary/dataset=…`` and the logs ``file_status``, ``cycle_status`` and
``file_state``.  Every write can be repeated: a retried micro-batch replaces
what it wrote before, and log readers take the latest row per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tableward.config import DEFAULTS, QualityConfig
from tableward.functions.columns import TEXT, columns_of_class, data_columns, nan_to_null
from tableward.functions.scalars import instant
from tableward.operators import status as St
from tableward.operators.missing import replace_null_tokens
from tableward.operators.textclean import clean_text
from tableward.plans.cleaning import add_indicators, clean, cleaning_summary
from tableward.plans.ingest import normalise, normalise_rows
from tableward.session import stage, temporary
from tableward.sources import manifest as Mf
from tableward.sources import sinks
from tableward.sources.readers import PATH, load

FILE_STATE = T.StructType(
    [T.StructField("name", T.StringType()), T.StructField("last_modified", T.TimestampNTZType())]
)


def read_log(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    path = f"{root}/{name}"
    return spark.read.schema(schema).parquet(path) if Mf.exists(spark, path) else spark.createDataFrame([], schema)


def _log_files(spark: SparkSession, root: str, rows: Iterable[tuple[str, str, str, str | None]], now) -> None:
    """Append ``(file, stage, status, error)`` events; names only, no data."""
    rows = list(rows)
    if rows:
        frame = spark.createDataFrame(rows, "file string, stage string, status string, error_message string")
        St.append_log(frame.select("file", "stage", "status", instant(now).alias("ts"), "error_message"), f"{root}/file_status")


def _log_cycle(spark: SparkSession, root: str, stage_name: str, status: str, now) -> None:
    frame = spark.createDataFrame([(stage_name, status)], "stage string, status string")
    St.append_log(frame.withColumn("ts", instant(now)), f"{root}/cycle_status")


def run_ingest(
    spark: SparkSession,
    source: str,
    root: str,
    label: str = "object_store",
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    files: DataFrame | None = None,
    max_age: bool = False,
) -> dict[str, int]:
    """One ingest cycle: new or modified files to raw datasets.

    A file that cannot be read is logged as ``error`` and tried again in the
    next cycle; the others go on.  With ``max_age`` files older than the configured
    age are left alone.  Returns how many files ended in each status.
    """
    with temporary(spark):  # the listing and parsed workbooks, which are written out by the end
        return _ingest(spark, source, root, label, cfg, now, files, max_age)


def _ingest(
    spark: SparkSession,
    source: str,
    root: str,
    label: str = "object_store",
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    files: DataFrame | None = None,
    max_age: bool = False,
) -> dict[str, int]:
    try:
        listed = files if files is not None else Mf.list_files(spark, source)
        state = read_log(spark, root, "file_state", FILE_STATE)
        if max_age:
            listed = Mf.newer_than(listed, now, cfg)
        fresh = stage(St.new_files(listed, state), "files")
        accepted, refused = Mf.split_by_size(fresh, cfg)
        base = Mf.qualified(spark, source)
        tally = {"ingested": 0, "error": 0}

        def name(path: str) -> str:
            return path[len(base) + 1 :]

        for part in load(spark, accepted, cfg):
            errors = dict(part.errors)
            if part.rows is not None and part.paths:
                try:
                    file = F.expr(f"substring({PATH}, {len(base) + 2})")
                    flow = normalise_rows if part.trimmed else normalise
                    sinks.write_raw(flow(part.rows, label, cfg, now, file), root, part.dataset)
                except Exception as e:  # isolate the layout
                    errors |= {p: f"{type(e).__name__}: {e}" for p in part.paths}
            done = [p for p in part.paths if p not in errors]
            if done:
                # the stamp the listing showed, not the time of this run
                seen = fresh.join(spark.createDataFrame([(p,) for p in done], "path string"), "path", "left_semi")
                seen.select("name", "last_modified").write.mode("append").parquet(f"{root}/file_state")
                _log_files(spark, root, [(part.dataset, "raw", "written", None)], now)
            _log_files(spark, root, [(name(p), "ingest", "ingested", None) for p in done], now)
            _log_files(spark, root, [(name(p), "ingest", "error", m) for p, m in errors.items()], now)
            tally["ingested"] += len(done)
            tally["error"] += len(errors)
        late = [(r["name"], "ingest", "error", r["error_message"]) for r in refused.collect()]
        _log_files(spark, root, late, now)
        tally["error"] += len(late)
        _log_cycle(spark, root, "ingest", "completed", now)
        return tally
    except Exception:
        _log_cycle(spark, root, "ingest", "error", now)
        raise


def pending_datasets(spark: SparkSession, root: str) -> DataFrame:
    """Raw datasets written since the version that was cleaned last: ``file, written_at``.

    A completed cleaning carries the ``written_at`` it has read, so rows that
    come while it runs are found next time.
    """
    log = read_log(spark, root, "file_status", St.FILE_STATUS)
    written = St.latest_per_key(log.where("stage = 'raw'"), ["file"]).select("file", F.col("ts").alias("written_at"))
    done = log.where("stage = 'cleaned_version'").groupBy("file").agg(F.max("ts").alias("cleaned_version"))
    pending = written.join(done, "file", "left").where("cleaned_version IS NULL OR cleaned_version < written_at")
    return pending.select("file", "written_at")


def run_clean(
    spark: SparkSession,
    root: str,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
) -> dict[str, str]:
    """One cleaning cycle over the pending datasets: cleaned data, summary, status.

    Of repeated rows the first by file and columns is kept, so reruns keep the same.
    """
    outcome: dict[str, str] = {}
    for row in pending_datasets(spark, root).collect():  # dataset names
        dataset = row["file"]
        try:
            _log_files(spark, root, [(dataset, "clean", "processing", None)], now)
            with temporary(spark):
                raw = sinks.read_raw(spark, root, dataset)
                order = tuple(c for c in ("source_file", "ingested_at") if c in raw.columns)
                sinks.write_cleaned(clean(raw, cfg, now, order), root, dataset)
                cleaned = sinks.read_cleaned(spark, root, dataset)
                sinks.write_summary(cleaning_summary(raw, cleaned, cfg, now), root, dataset)
            _log_files(spark, root, [(dataset, "cleaned_version", "completed", None)], row["written_at"])
            # a later row of the same instant must win over 'processing'
            _log_files(spark, root, [(dataset, "clean", "completed", None)], _after(now))
            outcome[dataset] = "completed"
        except Exception as e:  # isolate the dataset
            _log_files(spark, root, [(dataset, "clean", "error", f"{type(e).__name__}: {e}")], _after(now))
            outcome[dataset] = "error"
    _log_cycle(spark, root, "clean", "completed", now)
    return outcome


def _after(now: datetime | str | None):
    """A fixed clock moves on by a microsecond between two events of one file."""
    if now is None:
        return None
    fixed = datetime.fromisoformat(now) if isinstance(now, str) else now
    return fixed + timedelta(microseconds=1)


# -- streams -----------------------------------------------------------------


def clean_rows(df: DataFrame, cfg: QualityConfig = DEFAULTS, now: datetime | str | None = None) -> DataFrame:
    """The row-local cleaning steps; works on streaming and on batch frames."""
    tokens = replace_null_tokens(nan_to_null(df), cfg)
    return add_indicators(clean_text(tokens, cfg, columns_of_class(df, TEXT, among=data_columns(df, cfg))), cfg, now)


def file_stream(spark: SparkSession, source: str, max_files: int | None = None) -> DataFrame:
    """New files of a folder as a stream of manifest rows.

    A rewritten file does not come again here; the batch cycle, which compares
    modification times, finds those.
    """
    fields = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(fields).option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    listed = reader.load(source).select("path", "modificationTime", "length")
    return Mf.describe_files(listed, Mf.qualified(spark, source))


def _start(writer, trigger: str | None) -> StreamingQuery:
    timed = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return timed.start()


def stream_ingest(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    label: str = "object_store",
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    service: bool = False,
    max_files: int | None = None,
) -> StreamingQuery:
    """Ingest new files as they come; a job unless ``service``."""

    def batch(files: DataFrame, _: int) -> None:
        run_ingest(files.sparkSession, source, root, label, cfg, now, files)

    writer = file_stream(spark, source, max_files).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _start(writer, cfg.ingest_trigger if service else None)


def stream_clean(
    stream: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    service: bool = False,
) -> StreamingQuery:
    """Clean each micro-batch as a table of its own, table-level steps included.

    ``write`` gets the cleaned batch and its number, and should make writing
    the same number twice harmless.
    """

    def batch(df: DataFrame, number: int) -> None:
        if not df.isEmpty():
            with temporary(df.sparkSession):
                write(clean(df, cfg, now), number)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return _start(writer, cfg.clean_trigger if service else None)


def stream_rows_to(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    cfg: QualityConfig = DEFAULTS,
    now: datetime | str | None = None,
    service: bool = False,
) -> StreamingQuery:
    """Row-local cleaning straight into a Parquet sink, exactly once by the sink's own log."""
    writer = (
        clean_rows(stream, cfg, now).writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append")
    )
    return _start(writer, cfg.clean_trigger if service else None)


def distinct_within(stream: DataFrame, columns: list[str], event_time: str, delay: str) -> DataFrame:
    """Duplicates across micro-batches, remembered for as long as the watermark allows."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(columns)


def freshness(df: DataFrame, now: datetime | str | None = None, column: str = "cleaned_at") -> DataFrame:
    """Hours since the newest row."""
    age = F.timestamp_diff("MICROSECOND", F.max(F.col(column).cast("timestamp_ntz")), instant(now))
    return df.agg((age / F.lit(3_600_000_000.0)).alias("data_age_hours"))
