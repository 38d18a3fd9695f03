"""Registration, table access and the shared dirty view of ``events``."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Runner = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, tuple[Runner, str | None]] = {}

# The clock of every registered query.
NOW = "2024-01-20 00:00:00"

# The driver's tables hold no gaps, repeats or stray blanks.  This view makes
# some, with one text that reads the same in both engines: every branch of the
# cleaner has a column, and one day's events arrive twice.
DIRTY_BODY = """
  SELECT event_id, ts, user_id,
    CASE WHEN event_id % 11 = 0 THEN NULL
         WHEN event_id % 13 = 0 THEN 'N/A'
         WHEN event_id % 7 = 0 THEN concat('  ', upper(event_type), ' ')
         WHEN event_id % 5 = 0 THEN concat(upper(substring(event_type, 1, 1)), substring(event_type, 2))
         ELSE event_type END AS label,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS amount,
    CASE WHEN event_id % 15 = 0 THEN value + 100000 ELSE value END AS spiky,
    CASE WHEN event_id % 10 < 6 THEN CAST(event_id AS STRING) ELSE 'n.d.' END AS num_text,
    CASE WHEN event_id % 10 < 4 THEN CAST(event_id AS STRING) ELSE 'n.d.' END AS few_num_text,
    CAST(CAST(ts AS DATE) AS STRING) AS date_text,
    CASE WHEN event_id % 100 = 0 THEN 'unknown' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS mixed_date_text,
    CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id % 2 = 0 END AS flag,
    CASE WHEN event_id % 20 = 0 THEN 'x' ELSE NULL END AS sparse,
    CAST(NULL AS STRING) AS empty_col
  FROM {events}
"""
DIRTY = f"""WITH base AS ({DIRTY_BODY}), dirty AS (
  SELECT * FROM base UNION ALL SELECT * FROM base WHERE CAST(ts AS DATE) = DATE '2024-01-15')
"""
DIRTY_SQL = DIRTY.replace("{events}", "events")

DIRTY_KINDS = {
    "event_id": ("numeric", "bigint"), "ts": ("datetime", "timestamp_ntz"), "user_id": ("numeric", "bigint"),
    "label": ("text", "string"), "amount": ("numeric", "double"), "spiky": ("numeric", "double"),
    "num_text": ("text", "string"), "few_num_text": ("text", "string"), "date_text": ("text", "string"),
    "mixed_date_text": ("text", "string"), "flag": ("boolean", "boolean"), "sparse": ("text", "string"),
    "empty_col": ("text", "string"),
}
LINEITEM_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)


def query(sql: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        if run.__name__ in _REGISTRY:
            raise ValueError(f"query {run.__name__} exists already")
        _REGISTRY[run.__name__] = (run, sql)
        return run

    return register


def registered() -> dict[str, tuple[Runner, str | None]]:
    from tableward.registry import assessing, cleaning, exploring, files, streams, trips  # noqa: F401

    return dict(_REGISTRY)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(DIRTY + "SELECT * FROM dirty", events=table(spark, sf_dir, "events"))


def rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, places) for n in names})


def union(parts: Iterable[str]) -> str:
    return "\nUNION ALL\n".join(parts)
