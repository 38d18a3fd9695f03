"""Exploration operators on the given tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tableward.functions import scalars as S
from tableward.functions.names import cleaned_name, raw_name, summary_name
from tableward.operators import assess as A
from tableward.operators import explore as E
from tableward.registry.assessing import _OVERALL, DIRTY_SCORES
from tableward.registry.base import (
    DIRTY_KINDS, DIRTY_SQL, LINEITEM_NUMBERS, NOW, dirty, query, rounded, table, union,
)

# -- summaries ---------------------------------------------------------------


@query(
    union(
        f"""SELECT '{n}' AS "column", count({n}) AS "count", round(avg(CAST({n} AS DOUBLE)), 4) AS mean,
        round(stddev_samp(CAST({n} AS DOUBLE)), 4) AS std, CAST(min({n}) AS DOUBLE) AS min,
        round(quantile_cont(CAST({n} AS DOUBLE), 0.25), 6) AS p25, round(quantile_cont(CAST({n} AS DOUBLE), 0.5), 6) AS p50,
        round(quantile_cont(CAST({n} AS DOUBLE), 0.75), 6) AS p75, CAST(max({n}) AS DOUBLE) AS max FROM lineitem"""
        for n in LINEITEM_NUMBERS
    )
)
def describe(spark, sf_dir):
    found = E.describe(table(spark, sf_dir, "lineitem"))
    return rounded(rounded(found, 4, "mean", "std"), 6, "p25", "p50", "p75")


def top_sql(column: str, source: str, k: int) -> str:
    return (
        f"SELECT {column} AS value, count(*) AS n FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY n DESC, value LIMIT {k}"
    )


@query(top_sql("o_orderpriority", "orders", 10))
def value_counts_top(spark, sf_dir):
    return E.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority", 10)


@query(top_sql("l_suppkey", "lineitem", 20))
def bar_counts(spark, sf_dir):
    return E.value_counts(table(spark, sf_dir, "lineitem"), "l_suppkey", 20)


_FIRST_TEXTS = [n for n, (k, _) in DIRTY_KINDS.items() if k == "text"][:5]


@query(
    DIRTY_SQL
    + "SELECT * FROM ("
    + union(
        f"""SELECT '{n}' AS "column", {n} AS value, count(*) AS n,
        row_number() OVER (ORDER BY count(*) DESC, {n}) AS place FROM dirty WHERE {n} IS NOT NULL GROUP BY {n}"""
        for n in _FIRST_TEXTS
    )
    + ") WHERE place <= 10"
)
def text_value_counts(spark, sf_dir):
    return E.text_value_counts(dirty(spark, sf_dir))


@query("SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY l_suppkey")
def grouped_sum(spark, sf_dir):
    return rounded(E.grouped_sum(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_extendedprice"), 2, "total")


@query(
    f"SELECT value, n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS share FROM ({top_sql('p_brand', 'part', 10)})"
)
def category_share(spark, sf_dir):
    return rounded(E.category_share(table(spark, sf_dir, "part"), "p_brand"), 6, "share")


@query(
    f"SELECT value, n, round(CAST(n AS DOUBLE) / sum(n) OVER (), 6) AS share FROM ({top_sql('event_type', 'events', 3)})"
)
def share_of_total(spark, sf_dir):
    return rounded(E.category_share(table(spark, sf_dir, "events"), "event_type", 3), 6, "share")


# -- relations ---------------------------------------------------------------


@query(
    "SELECT var_x, var_y, CASE WHEN isnan(corr) THEN NULL ELSE round(corr, 6) END AS corr FROM ("
    + union(
        f"SELECT '{a}' AS var_x, '{b}' AS var_y, corr(CAST({b} AS DOUBLE), CAST({a} AS DOUBLE)) AS corr FROM lineitem"
        for a in LINEITEM_NUMBERS
        for b in LINEITEM_NUMBERS
        if a != b
    )
    + ")\nUNION ALL\n"
    + union(f"SELECT '{a}', '{a}', CAST(1 AS DOUBLE) FROM lineitem HAVING min({a}) < max({a})" for a in LINEITEM_NUMBERS)
)
def corr_matrix(spark, sf_dir):
    return rounded(E.correlation_matrix(table(spark, sf_dir, "lineitem")), 6, "corr")


_GAPPY = ("user_id", "amount", "spiky", "odd")


@query(
    f"{DIRTY_SQL}, g AS (SELECT user_id, amount, spiky, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS odd "
    f"FROM dirty JOIN (SELECT event_id AS eid, value FROM events) e ON event_id = eid) "
    + "SELECT var_x, var_y, CASE WHEN isnan(corr) THEN NULL ELSE round(corr, 6) END AS corr FROM ("
    + union(
        f"SELECT '{a}' AS var_x, '{b}' AS var_y, corr(CAST({b} AS DOUBLE), CAST({a} AS DOUBLE)) AS corr FROM g"
        for a, b in combinations(_GAPPY, 2)
    )
    + ")"
)
def corr_pairs_with_gaps(spark, sf_dir):
    source = table(spark, sf_dir, "events").select(F.col("event_id").alias("eid"), "value")
    soiled = dirty(spark, sf_dir)
    gaps = soiled.join(source, soiled.event_id == source.eid).select(
        "user_id", "amount", "spiky", F.expr("CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END").alias("odd")
    )
    return rounded(E.correlation_pairs(gaps), 6, "corr")


@query(
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept,
       min(l_quantity) AS x_min, max(l_quantity) AS x_max FROM lineitem"""
)
def linear_trend(spark, sf_dir):
    found = E.linear_trend(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(rounded(found, 4, "slope"), 2, "intercept")


@query(
    """SELECT point, round(x_min + (x_max - x_min) / 99 * point, 6) AS x, round(slope * (x_min + (x_max - x_min) / 99 * point) + intercept, 2) AS y
       FROM (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS intercept,
             min(l_quantity) AS x_min, max(l_quantity) AS x_max FROM lineitem),
            (SELECT CAST(unnest(range(100)) AS INTEGER) AS point)"""
)
def trend_line(spark, sf_dir):
    return rounded(rounded(E.trend_line(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice"), 6, "x"), 2, "y")


@query("SELECT l_quantity, l_extendedprice, l_returnflag, l_orderkey, l_partkey, l_suppkey FROM lineitem")
def scatter_points(spark, sf_dir):
    return E.scatter_points(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag")


# -- distributions -----------------------------------------------------------


@query(
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
       c AS (SELECT least(CAST(floor(30 * (value - lo) / (hi - lo)) AS BIGINT) + 1, 30) AS bin, count(*) AS n FROM events, e GROUP BY bin)
       SELECT b.bin, round(lo + (hi - lo) / 30 * (b.bin - 1), 6) AS lower, round(lo + (hi - lo) / 30 * b.bin, 6) AS upper, coalesce(n, 0) AS n
       FROM (SELECT unnest(range(1, 31)) AS bin) b LEFT JOIN c ON b.bin = c.bin, e"""
)
def histogram(spark, sf_dir):
    return rounded(E.histogram(table(spark, sf_dir, "events"), "value"), 6, "lower", "upper")


def box_sql(n: str, source: str) -> str:
    return f"""SELECT '{n}' AS "column", count(*) AS n, q1, median, q3,
      min({n}) FILTER ({n} >= q1 - 1.5 * (q3 - q1)) AS whisker_low, max({n}) FILTER ({n} <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
      count(*) FILTER ({n} < q1 - 1.5 * (q3 - q1) OR {n} > q3 + 1.5 * (q3 - q1)) AS outliers
      FROM {source}, (SELECT quantile_cont({n}, 0.25) AS q1, quantile_cont({n}, 0.5) AS median, quantile_cont({n}, 0.75) AS q3 FROM {source}) q
      GROUP BY q1, median, q3"""


_BOX_ROUND = "round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3"


@query(
    f'SELECT "column", n, {_BOX_ROUND}, whisker_low, whisker_high, outliers FROM ('
    + union(box_sql(n, "lineitem") for n in ("l_quantity", "l_extendedprice", "l_discount"))
    + ")"
)
def box_stats(spark, sf_dir):
    names = ("l_quantity", "l_extendedprice", "l_discount")
    return rounded(E.box_stats(table(spark, sf_dir, "lineitem"), names), 6, "q1", "median", "q3")


@query(
    """SELECT event_id, value FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
       WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)"""
)
def box_outliers(spark, sf_dir):
    return E.box_outliers(table(spark, sf_dir, "events").select("event_id", "value"), "value")


@query(
    """SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
       round(quantile_cont(value, 0.75), 6) AS q3 FROM events GROUP BY event_type"""
)
def violin_box(spark, sf_dir):
    return rounded(E.violin_box(table(spark, sf_dir, "events"), "value", "event_type"), 6, "q1", "median", "q3")


@query(
    """SELECT "group", bin, n, round(n / (sum(n) OVER (PARTITION BY "group") * (hi - lo) / 30), 8) AS density FROM (
       SELECT event_type AS "group", least(CAST(floor(30 * (value - lo) / (hi - lo)) AS BIGINT) + 1, 30) AS bin, lo, hi, count(*) AS n
       FROM events, (SELECT min(value) AS lo, max(value) AS hi FROM events) e GROUP BY event_type, bin, lo, hi)"""
)
def violin_density(spark, sf_dir):
    return rounded(E.violin_density(table(spark, sf_dir, "events"), "value", "event_type"), 8, "density")


# Means of prices often end in an exact half of the last place shown; the order
# of summation would decide the rounding, so both sides lift the value first.
@query("SELECT l_returnflag, l_suppkey, round(avg(l_extendedprice) + CAST(1e-7 AS DOUBLE), 4) AS mean_value FROM lineitem GROUP BY l_returnflag, l_suppkey")
def pivot_mean(spark, sf_dir):
    means = E.pivot_mean(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_returnflag", "l_extendedprice")
    return means.withColumn("mean_value", F.round(F.col("mean_value") + F.lit(1e-7), 4))


@query(
    """SELECT l_returnflag, round(avg(l_quantity) FILTER (l_linestatus = 'F'), 4) AS "F", round(avg(l_quantity) FILTER (l_linestatus = 'O'), 4) AS "O"
       FROM lineitem GROUP BY l_returnflag"""
)
def pivot_mean_wide(spark, sf_dir):
    wide = E.pivot_mean(table(spark, sf_dir, "lineitem"), "l_linestatus", "l_returnflag", "l_quantity", ["F", "O"])
    return rounded(wide, 4, "F", "O")


@query(
    union(
        f"SELECT l_shipdate, '{c}' AS series, {c} AS value FROM lineitem" for c in ("l_quantity", "l_discount", "l_tax")
    )
)
def multi_series(spark, sf_dir):
    return E.multi_series(table(spark, sf_dir, "lineitem"), "l_shipdate", ["l_quantity", "l_discount", "l_tax"])


# -- time --------------------------------------------------------------------


@query("SELECT o_orderdate, o_totalprice FROM orders")
def time_series(spark, sf_dir):
    return E.time_series(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice")


@query(
    """SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS bucket, round(avg(o_totalprice), 4) AS mean_value, count(o_totalprice) AS n
       FROM orders GROUP BY bucket"""
)
def time_series_bucket(spark, sf_dir):
    return rounded(E.time_series(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "month"), 4, "mean_value")


def _period(unit: str) -> str:
    return (
        f"SELECT CAST(date_trunc('{unit}', ts) AS TIMESTAMP) AS period, count(*) AS n, round(sum(value), 4) AS total, "
        "round(avg(value), 4) AS mean_value FROM events GROUP BY period"
    )


@query(_period("day"))
def daily_summary(spark, sf_dir):
    return rounded(E.period_summary(table(spark, sf_dir, "events"), "ts", "value", "day"), 4, "total", "mean_value")


@query(_period("week"))
def weekly_summary(spark, sf_dir):
    return rounded(E.period_summary(table(spark, sf_dir, "events"), "ts", "value", "week"), 4, "total", "mean_value")


@query(f"SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 7 DAY")
def recency_filter(spark, sf_dir):
    return E.recent(table(spark, sf_dir, "events").select("event_id", "ts"), "Last Week", NOW, "ts")


@query("SELECT event_id, ts FROM events")
def recency_fallback(spark, sf_dir):
    """No event is that young, so all of them are kept."""
    return E.recent(table(spark, sf_dir, "events").select("event_id", "ts"), "Last Hour", "2025-01-01 00:00:00", "ts")


@query("SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-02-14' - INTERVAL 30 DAY")
def retention_filter(spark, sf_dir):
    return E.retained(table(spark, sf_dir, "events").select("event_id", "ts"), "2024-02-14 00:00:00", "ts")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_partkey OFFSET 500 LIMIT 1000")
def row_slice(spark, sf_dir):
    order = ("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey")
    return E.row_slice(table(spark, sf_dir, "lineitem"), order, 500, 1000, ["l_orderkey", "l_linenumber", "l_extendedprice"])


@query(
    """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"""
)
def top_k(spark, sf_dir):
    return E.top_rows(table(spark, sf_dir, "orders"), ["o_totalprice"], ["o_orderkey"], 10).select("o_orderkey", "o_totalprice")


# -- display -----------------------------------------------------------------

def number_text(n: str) -> str:
    return (
        f"CASE WHEN {n} >= 1000000 THEN printf('%.1fM', CAST({n} AS DOUBLE) / 1000000) "
        f"WHEN {n} >= 1000 THEN printf('%.1fK', CAST({n} AS DOUBLE) / 1000) ELSE CAST({n} AS STRING) END"
    )


@query(
    f"""SELECT o_orderkey, {number_text("o_totalprice")} AS price_text, {number_text("o_orderkey")} AS key_text,
        CASE WHEN size < 1024 THEN printf('%.1f B', size) WHEN size < 1048576 THEN printf('%.1f KB', size / 1024)
             WHEN size < 1073741824 THEN printf('%.1f MB', size / 1048576) WHEN size < 1099511627776 THEN printf('%.1f GB', size / 1073741824)
             ELSE printf('%.1f TB', size / 1099511627776) END AS size_text
        FROM (SELECT *, CAST(o_orderkey AS DOUBLE) * o_orderkey * o_orderkey AS size FROM orders)"""
)
def human_units(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        S.human_number(F.col("o_totalprice")).alias("price_text"),
        S.human_number(key).alias("key_text"),
        S.human_bytes(key.cast("double") * key * key).alias("size_text"),
    )


@query(
    """SELECT DISTINCT f AS file, concat('raw_', f) AS raw_name, concat('cleaned_', f) AS cleaned_name,
       concat('summary_', replace(f, '.csv', '.json')) AS summary_name FROM (SELECT concat(event_type, '_', user_id, '.csv') AS f FROM events)"""
)
def dataset_names(spark, sf_dir):
    files = table(spark, sf_dir, "events").select(F.format_string("%s_%d.csv", "event_type", "user_id").alias("file")).distinct()
    return files.withColumn("raw_name", raw_name(F.col("file"))).select(
        "file", "raw_name",
        cleaned_name(F.col("raw_name")).alias("cleaned_name"),
        summary_name(F.col("raw_name")).alias("summary_name"),
    )


@query(
    f"""{DIRTY_SCORES}, found AS (SELECT total_rows, total_columns, {_OVERALL} FROM scores)
    SELECT total_rows, total_columns, overall_score AS quality_score,
      (SELECT round(CAST(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS DOUBLE) / 3600000000, 6) FROM dirty) AS data_age_hours
    FROM found"""
)
def overview(spark, sf_dir):
    """The score comes from the table's own report."""
    soiled = dirty(spark, sf_dir)
    report = rounded(A.quality_scores(soiled, now=NOW), 4, "overall_score")
    found = E.overview(soiled, report, "2024-02-01 00:00:00", "ts")
    return rounded(found, 6, "data_age_hours")


@query(
    DIRTY_SCORES
    + union(
        f"SELECT '{m}' AS metric, {m}_score AS score, CASE WHEN {m}_score >= 80 THEN 'normal' WHEN {m}_score >= 60 THEN 'warning' ELSE 'error' END AS band FROM scores"
        for m in ("completeness", "uniqueness", "consistency", "validity")
    )
)
def quality_bands(spark, sf_dir):
    return E.quality_bands(A.quality_scores(dirty(spark, sf_dir), now=NOW))


@query(
    DIRTY_SQL
    + """SELECT 'label' AS "column", 'string' AS data_type, count(*) AS total_count, count(label) AS non_null_count, count(*) - count(label) AS null_count,
       count(DISTINCT label) AS unique_values,
       (SELECT label FROM (SELECT label, count(*) AS n FROM dirty WHERE label IS NOT NULL GROUP BY label) ORDER BY n DESC, label LIMIT 1) AS most_common,
       CAST(NULL AS DOUBLE) AS mean_value, CAST(NULL AS DOUBLE) AS std_deviation FROM dirty
       UNION ALL SELECT 'amount', 'double', count(*), count(amount), count(*) - count(amount), count(DISTINCT amount), NULL,
       round(avg(amount), 2), round(stddev_samp(amount), 2) FROM dirty"""
)
def profiling_card(spark, sf_dir):
    df = dirty(spark, sf_dir)
    return E.profiling_card(df, "label").unionByName(E.profiling_card(df, "amount"))


@query(DIRTY_SQL + top_sql("label", "dirty", 10))
def column_detail_text(spark, sf_dir):
    return E.column_detail(dirty(spark, sf_dir), "label")[1]


@query(
    DIRTY_SQL
    + """SELECT 'amount' AS "column", 'double' AS data_type, count(amount) AS non_null_count, count(*) - count(amount) AS null_count,
       count(DISTINCT amount) AS unique_values FROM dirty"""
)
def column_detail(spark, sf_dir):
    return E.column_detail(dirty(spark, sf_dir), "amount")[0]


@query(
    """SELECT data_type, columns, (SELECT count(*) FROM lineitem) AS total_rows FROM
       (VALUES ('bigint', 3), ('int', 1), ('double', 4), ('string', 2), ('timestamp_ntz', 1)) AS t(data_type, columns)"""
)
def type_counts(spark, sf_dir):
    return E.type_counts(table(spark, sf_dir, "lineitem"))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def select_data_columns(spark, sf_dir):
    df = table(spark, sf_dir, "events").withColumn("ingested_at", F.col("ts")).withColumn("data_source", F.lit("x"))
    return E.data_only(df)


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate FROM lineitem")
def select_by_class(spark, sf_dir):
    return E.by_class(table(spark, sf_dir, "lineitem"), "numeric", "datetime")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS detail_k, event_type AS detail_origin_kind FROM events")
def flatten_nested(spark, sf_dir):
    nested = table(spark, sf_dir, "events").select(
        "event_id",
        F.struct(
            F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
            F.struct(F.col("event_type").alias("kind")).alias("origin"),
        ).alias("detail"),
    )
    return E.flatten(nested)
