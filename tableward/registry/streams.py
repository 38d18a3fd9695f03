"""Cleaning as Structured Streaming, over the tables' files as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableward.registry.base import DIRTY_BODY, DIRTY_KINDS, DIRTY_SQL, NOW, query, table
from tableward.registry.cleaning import CLEANED, doubles, swap
from tableward.session import place
from tableward.streaming import jobs as J

_TEXT = [n for n, (k, _) in DIRTY_KINDS.items() if k == "text"]


def _tidy_or_token(n: str) -> str:
    tokens = "'', ' ', 'NULL', 'null', 'None', 'none', 'N/A', 'n/a', 'NA', 'na'"
    return (
        f"CASE WHEN {n} IS NULL OR {n} IN ({tokens}) OR trim({n}) IN ('', 'nan') THEN 'unknown' ELSE lower(trim({n})) END"
    )


_HELD = " + ".join(f"CASE WHEN {n} IS NULL THEN 0 ELSE 1 END" for n in DIRTY_KINDS if n not in _TEXT)


def _soiled_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return spark.sql(DIRTY_BODY, events=stream)


@query(
    DIRTY_SQL
    + f"SELECT {swap({n: _tidy_or_token(n) for n in _TEXT})}, TIMESTAMP '{NOW}' AS cleaned_at, "
    f"round(CAST({_HELD} + {len(_TEXT)} AS DOUBLE) / {len(DIRTY_KINDS)} * 100, 2) AS completeness_score FROM base"
)
def stream_clean(spark, sf_dir):
    """Row-local cleaning: stream to a Parquet sink, then read the sink."""
    out = place(spark, "stream-rows")
    J.stream_rows_to(_soiled_stream(spark, sf_dir), out, place(spark, "cp"), now=NOW).awaitTermination()
    return spark.read.parquet(out)


@query(CLEANED + "SELECT * FROM cleaned")
def stream_clean_batches(spark, sf_dir):
    """Table-level cleaning per micro-batch; the table is one file, hence one batch."""
    out = place(spark, "stream-batches")

    def write(df, number):
        df.write.mode("overwrite").parquet(f"{out}/batch={number}")

    J.stream_clean(_soiled_stream(spark, sf_dir), write, place(spark, "cp"), now=NOW).awaitTermination()
    return doubles(spark.read.parquet(out).drop("batch"), "event_id", "user_id")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_distinct(spark, sf_dir):
    """Duplicates across micro-batches, within the watermark."""
    schema = table(spark, sf_dir, "events").schema
    stream = (
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
        .withColumn("ts", F.col("ts").cast("timestamp"))
    )
    out = place(spark, "stream-distinct")
    unique = J.distinct_within(stream.unionAll(stream), ["event_id"], "ts", "1 day")
    writer = unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", place(spark, "cp"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT round(CAST(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS DOUBLE) / 3600000000, 6) AS data_age_hours FROM events")
def freshness(spark, sf_dir):
    found = J.freshness(table(spark, sf_dir, "events"), "2024-02-01 00:00:00", "ts")
    return found.select(F.round("data_age_hours", 6).alias("data_age_hours"))
