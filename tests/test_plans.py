"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from tableward.operators import assess as A
from tableward.operators import dedupe as D
from tableward.operators import explore as E
from tableward.operators import profile as P
from tableward.operators import quantiles as Q
from tableward.operators import status as St
from tableward.registry import registered
from tests.compare import TESTDATA

SF = f"{TESTDATA}/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def jobs(spark, run):
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup())
    run()
    return len(set(tracker.getJobIdsForGroup()) - before)


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{SF}/lineitem.parquet")


def test_no_python_in_query_plans(spark):
    for name in ("column_profile", "uniqueness", "dedupe", "clean_text", "histogram", "latest_status", "line_numbers"):
        text = plan(registered()[name][0](spark, SF))
        assert "Python" not in text and "MapInPandas" not in text, name


def test_no_cartesian_product(spark):
    for name in ("quality_scores", "stats_broadcast", "histogram", "trend_line", "report_join", "corr_matrix"):
        text = plan(registered()[name][0](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_counters_are_one_scan(lineitem):
    text = plan(P.measure(lineitem, lineitem.columns, (*P.BASE, *P.NUMBERS, *P.LENGTHS)))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_job_count_does_not_grow_with_columns(spark):
    def table(k):
        return spark.range(500).select(*[(F.col("id") * (i + 3) % 101).alias(f"c{i}") for i in range(k)])

    narrow, wide = table(3), table(12)
    few = jobs(spark, lambda: A.column_quality(narrow).collect())
    many = jobs(spark, lambda: A.column_quality(wide).collect())
    assert many <= few


def test_pruned_columns_and_pushed_filter(spark, lineitem):
    text = plan(E.grouped_sum(lineitem.where("l_quantity > 10"), "l_suppkey", "l_extendedprice"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,10.0)]" in text
    assert "ReadSchema: struct<l_suppkey:bigint,l_quantity:double,l_extendedprice:double>" in text
    assert "l_tax" not in plan(E.histogram(lineitem, "l_quantity"))


def test_duplicates_collapse_before_the_shuffle(lineitem):
    text = plan(D.drop_duplicates(lineitem))
    assert text.count("HashAggregate") == 2 and text.count("hashpartitioning") == 1
    text = plan(D.keep_first(lineitem, ["l_partkey"], ["l_shipdate", "l_orderkey"]))
    assert text.count("WindowGroupLimit") == 2


def test_latest_status_is_an_aggregate(spark):
    log = spark.createDataFrame([], St.FILE_STATUS)
    text = plan(St.latest_per_key(log, ["file"]))
    assert "Window" not in text and "partial_max" in text


def test_column_search_never_unpivots_the_table(spark, lineitem, monkeypatch):
    monkeypatch.setattr(Q, "_long", None)
    small = Q.DEFAULTS.__class__(quantile_inline_rows=10)
    assert Q.quantile_values(lineitem, ["l_quantity"], (0.5,), small)["l_quantity"][0] > 0


def test_no_pair_or_row_explosion_in_top_values(spark, lineitem):
    text = plan(E.text_value_counts(lineitem))
    assert text.count("WindowGroupLimit") == 2
