"""File lists, status logs and file-level operators, over rows derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableward.operators import status as St
from tableward.registry.base import query, table, union
from tableward.sources import manifest as Mf
from tableward.sources import readers as R

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# A manifest: one file per user and event type, changed when its last event came.
_MANIFEST_SQL = "SELECT concat(event_type, '_', user_id, '.csv') AS name, max(ts) AS last_modified, count(*) AS size FROM {0} GROUP BY name"
_EARLIER = "(SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-25')"


def _manifest(events):
    name = F.format_string("%s_%d.csv", "event_type", "user_id")
    return events.groupBy(name.alias("name")).agg(F.max("ts").alias("last_modified"), F.count("*").alias("size"))


@query(
    f"""SELECT m.name, m.last_modified, m.size FROM ({_MANIFEST_SQL.format("events")}) m
        WHERE NOT EXISTS (SELECT 1 FROM ({_MANIFEST_SQL.format(_EARLIER)}) s WHERE s.name = m.name AND s.last_modified = m.last_modified)"""
)
def incremental_files(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    state = _manifest(events.where("ts < TIMESTAMP_NTZ '2024-01-25 00:00:00'"))
    return St.new_files(_manifest(events), state).select("name", "last_modified", "size")


# A status log: each order is an event of its customer's file.
_LOG_SQL = """SELECT concat('raw_', o_custkey, '.csv') AS file,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'ingest' ELSE 'clean' END AS stage,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'processing' ELSE 'error' END AS status,
  CAST(o_orderdate AS TIMESTAMP) AS ts,
  CASE WHEN o_orderstatus = 'P' THEN o_orderpriority END AS error_message FROM orders"""
_LATEST_SQL = """SELECT file, stage, status, ts, error_message FROM (SELECT *, row_number() OVER (
  PARTITION BY file, stage ORDER BY ts DESC, status DESC, error_message DESC) AS rn FROM log) WHERE rn = 1"""


def _log(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.format_string("raw_%d.csv", "o_custkey").alias("file"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "ingest").otherwise("clean").alias("stage"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "processing").otherwise("error").alias("status"),
        F.col("o_orderdate").alias("ts"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).alias("error_message"),
    )


@query(f"WITH log AS ({_LOG_SQL}) {_LATEST_SQL}")
def latest_status(spark, sf_dir):
    return St.latest_per_key(_log(spark, sf_dir), ["file", "stage"])


@query(
    f"""WITH log AS ({_LOG_SQL}), latest AS ({_LATEST_SQL})
        SELECT file, orders_held FROM (SELECT file, count(*) AS orders_held FROM log GROUP BY file) f
        WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.file = f.file AND l.stage = 'clean' AND l.status = 'completed')"""
)
def unprocessed_files(spark, sf_dir):
    log = _log(spark, sf_dir)
    files = log.groupBy("file").agg(F.count("*").alias("orders_held"))
    return St.unprocessed_files(files, log)


@query(
    f"""WITH log AS ({_LOG_SQL}), latest AS ({_LATEST_SQL}),
        wide AS (SELECT file,
          coalesce(max(CASE WHEN stage = 'ingest' THEN status END), 'unknown') AS ingest_status,
          coalesce(max(CASE WHEN stage = 'clean' THEN status END), 'unknown') AS clean_status,
          max(CASE WHEN stage = 'ingest' THEN ts END) AS ingest_last_run, max(CASE WHEN stage = 'clean' THEN ts END) AS clean_last_run
          FROM latest GROUP BY file)
        SELECT *, CASE WHEN ingest_status = 'completed' AND clean_status = 'completed' THEN 'healthy'
          WHEN ingest_status = 'error' OR clean_status = 'error' THEN 'error' ELSE 'warning' END AS overall FROM wide"""
)
def stage_status(spark, sf_dir):
    return St.pipeline_status(_log(spark, sf_dir).select("file", "stage", "status", "ts"), ["file"])


@query(
    f"""WITH log AS ({_LOG_SQL}), latest AS ({_LATEST_SQL})
        SELECT ts, concat('Cleaned ', file) AS event, status,
          CASE status WHEN 'completed' THEN 'green' WHEN 'processing' THEN 'yellow' WHEN 'error' THEN 'red' ELSE 'white' END AS mark,
          strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown_at
        FROM latest WHERE stage = 'clean' ORDER BY ts DESC, file LIMIT 10"""
)
def timeline(spark, sf_dir):
    return St.timeline(_log(spark, sf_dir))


_DAY_SQL = "SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events {0} GROUP BY day"


@query(
    f"""SELECT concat('cleaned_', c.day, '.csv') AS dataset, c.n AS rows, r.n AS error_rows
        FROM ({_DAY_SQL.format("")}) c LEFT JOIN ({_DAY_SQL.format("WHERE event_type = 'error' AND value > 100")}) r ON c.day = r.day"""
)
def report_join(spark, sf_dir):
    """Each day's events are a cleaned dataset; days with costly errors have a report."""
    day = F.date_format("ts", "yyyy-MM-dd")
    events = table(spark, sf_dir, "events").withColumn("day", day)
    catalogue = events.groupBy(F.concat(F.lit("cleaned_"), "day", F.lit(".csv")).alias("dataset")).agg(F.count("*").alias("rows"))
    reports = (
        events.where("event_type = 'error' AND value > 100")
        .groupBy(F.concat(F.lit("summary_"), "day", F.lit(".json")).alias("report"))
        .agg(F.count("*").alias("error_rows"))
    )
    return St.pair_reports(catalogue, reports).select("dataset", "rows", "error_rows")


@query(
    """SELECT concat(event_type, '_', user_id, '.csv') AS name, max(ts) AS last_modified, count(*) AS size FROM events
       GROUP BY name ORDER BY last_modified DESC, name"""
)
def newest_first(spark, sf_dir):
    return Mf.newest_first(_manifest(table(spark, sf_dir, "events")))


@query("SELECT event_type, arg_max(event_id, ts) AS latest_event, arg_min(event_id, ts) AS oldest_event, max(ts) AS latest_update FROM events GROUP BY event_type")
def latest_oldest(spark, sf_dir):
    order = F.struct("ts", "event_id")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(
        F.max_by("event_id", order).alias("latest_event"),
        F.min_by("event_id", order).alias("oldest_event"),
        F.max("ts").alias("latest_update"),
    )


@query(
    f"SELECT {len(_TABLES)} AS total_files, (SELECT CAST(sum(n) AS BIGINT) FROM ("
    + union(f"SELECT count(*) AS n FROM {t}" for t in _TABLES)
    + ")) AS total_rows"
)
def data_summary(spark, sf_dir):
    paths = [f"{sf_dir}/{t}.parquet" for t in _TABLES]
    return Mf.catalogue_summary(spark, *paths).select("total_files", "total_rows")


@query(union(f"SELECT '{t}.parquet' AS file, count(*) AS rows FROM {t}" for t in _TABLES))
def rows_per_file(spark, sf_dir):
    paths = [f"{sf_dir}/{t}.parquet" for t in _TABLES]
    return Mf.parquet_row_counts(spark, *paths).select("file", "rows")


@query(
    """SELECT doc_id, unnest(lines) AS text_content, CAST(unnest(range(1, len(lines) + 1)) AS INTEGER) AS line_number FROM
       (SELECT doc_id, string_split(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10)) AS lines FROM documents)"""
)
def line_numbers(spark, sf_dir):
    return R.split_lines(table(spark, sf_dir, "documents"), "text", ["doc_id"])


@query("SELECT page_id, octet_length(encode(html)) AS bytes, html AS decoded FROM pages")
def decode_fallback(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("content"))
    return pages.select(
        "page_id", F.octet_length("content").cast("bigint").alias("bytes"), R.decode_with_fallback(F.col("content")).alias("decoded")
    )
