"""Approximate statistics against the exact ones, within the bounds they state."""

import math

import pytest
from pyspark.sql import functions as F

from tableward.operators import assess as A
from tableward.operators import explore as E
from tableward.operators import sketches as S
from tests.compare import TESTDATA

#: Four standard errors of a distinct count; the rank error of a quantile, doubled.
DISTINCT, RANK = 4 * 1.04 / math.sqrt(2**S.LG_K), 2 * 2.3 / S.K**0.97


@pytest.fixture(scope="module")
def lineitem(spark):
    return spark.read.parquet(f"{TESTDATA}/sf0.01/lineitem.parquet")


def by_column(df):
    return {r["column"]: r for r in df.collect()}


def assert_close(df, found, columns):
    total = df.count()
    for name, r in found.items():
        exact = df.select(name).where(F.col(name).isNotNull()).distinct().count()
        assert (r["total_count"], r["non_null_count"]) == (total, df.where(F.col(name).isNotNull()).count()), name
        assert abs(r["unique_values"] - exact) <= DISTINCT * exact, name
        if exact < 100:
            assert r["unique_values"] == exact, name
        if name in columns:
            low, high = df.agg(F.min(name), F.max(name)).first()
            assert (r["min_value"], r["max_value"]) == (low, high)
            for label, prob in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
                below = df.where(F.col(name) < r[label]).count() / total
                upto = df.where(F.col(name) <= r[label]).count() / total
                assert below - RANK <= prob <= upto + RANK, (name, label)


def test_profile_is_within_its_bounds(lineitem):
    names = ["l_orderkey", "l_quantity", "l_extendedprice", "l_linestatus", "l_shipdate"]
    found = by_column(S.approximate_profile(lineitem, names))
    assert sorted(found) == sorted(names)
    assert_close(lineitem, found, names[:3])
    assert found["l_linestatus"]["p50"] is None and found["l_shipdate"]["min_value"] is None


def test_stored_partitions_merge_and_are_replaced_one_by_one(spark, lineitem, tmp_path):
    names, path = ["l_orderkey", "l_extendedprice", "l_linestatus"], str(tmp_path / "sketches")
    some = lineitem.where("l_linenumber < 3")
    S.write_sketches(S.column_sketches(some, names, ["l_returnflag"]), path, ["l_returnflag"])
    before = {f.name: f.stat().st_mtime_ns for f in (tmp_path / "sketches" / "l_returnflag=N").glob("*.parquet")}
    # one partition comes again, grown
    grown = lineitem.where("l_returnflag = 'R'")
    S.write_sketches(S.column_sketches(grown, names, ["l_returnflag"]), path, ["l_returnflag"])
    assert before == {f.name: f.stat().st_mtime_ns for f in (tmp_path / "sketches" / "l_returnflag=N").glob("*.parquet")}
    now = some.where("l_returnflag <> 'R'").unionByName(grown)
    kept = spark.read.parquet(path)
    assert_close(now, by_column(S.sketch_profile(kept)), names[:2])
    of_flag = S.sketch_profile(kept, ["l_returnflag"]).where("l_returnflag = 'R'")
    assert_close(grown, by_column(of_flag), names[:2])


def test_gaps_empty_tables_and_odd_names(spark):
    rows = spark.createDataFrame(
        [(1.0, None, "a", [1]), (float("nan"), None, "a", None), (-0.0, None, None, [1]), (0.0, None, "b", [2])],
        "`a.b` double, none double, t string, l array<int>",
    )
    found = by_column(S.approximate_profile(rows))
    assert [found["a.b"][c] for c in ("total_count", "non_null_count", "unique_values", "min_value", "max_value")] == [4, 3, 2, 0.0, 1.0]
    assert [found["none"][c] for c in ("total_count", "non_null_count", "unique_values", "uniqueness", "p50")] == [4, 0, 0, None, None]
    assert found["t"]["unique_values"] == 2 and found["l"]["unique_values"] == 2
    empty = by_column(S.approximate_profile(rows.limit(0)))
    assert {(r["total_count"], r["unique_values"], r["p50"]) for r in empty.values()} == {(0, 0, None)}
    assert S.column_sketches(rows.limit(0), by=["t"]).count() == 0


def test_rows_are_not_shuffled(lineitem):
    plan = S.column_sketches(lineitem, ["l_orderkey", "l_linestatus"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "partial_hll_sketch_agg" in plan


def test_approximate_describe_is_one_scan(lineitem):
    names = ["l_orderkey", "l_quantity", "l_extendedprice"]
    found = E.describe(lineitem, names, approximate=True)
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    exact, total = by_column(E.describe(lineitem, names)), lineitem.count()
    for name, r in by_column(found).items():
        for same in ("count", "min", "max"):
            assert r[same] == exact[name][same]
        assert r["mean"] == pytest.approx(exact[name]["mean"]) and r["std"] == pytest.approx(exact[name]["std"])
        for label, prob in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            assert lineitem.where(F.col(name) < r[label]).count() / total - RANK <= prob
            assert lineitem.where(F.col(name) <= r[label]).count() / total + RANK >= prob


def test_matrix_takes_its_diagonal_from_the_first_pass(lineitem):
    found = E.correlation_matrix(lineitem.withColumn("fixed", F.lit(1)), ["l_quantity", "l_tax", "fixed"])
    assert found._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    ones = {r["var_x"]: r["corr"] for r in found.where("var_x = var_y").collect()}
    assert ones == {"l_quantity": 1.0, "l_tax": 1.0, "fixed": None}


def test_approximate_uniqueness(spark, lineitem):
    some = lineitem.select("l_orderkey", "l_returnflag", F.lit(None).cast("double").alias("none"))
    exact, found = by_column(A.uniqueness(some)), by_column(A.uniqueness(some, approximate=True))
    assert found["l_returnflag"] == exact["l_returnflag"] and found["none"] == exact["none"]
    assert found["l_orderkey"]["unique_values"] == pytest.approx(exact["l_orderkey"]["unique_values"], rel=DISTINCT)
