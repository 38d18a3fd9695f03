"""Hand-worked frames, one per operator and rule."""

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tableward.config import DEFAULTS
from tableward.functions import names as N
from tableward.functions import scalars as S
from tableward.operators import assess as A
from tableward.operators import checks as C
from tableward.operators import dedupe as D
from tableward.operators import explore as E
from tableward.operators import missing as M
from tableward.operators import outliers as O
from tableward.operators import status as St
from tableward.operators import textclean as X
from tableward.plans import cleaning as P
from tableward.plans.ingest import normalise


def values(df, column):
    return [r[column] for r in df.collect()]


def one(spark, xs, kind="string", name="v"):
    return spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"id int, {name} {kind}")


def by_id(df, column="v"):
    return [r[column] for r in df.orderBy("id").collect()]


# names


def test_ingest_names():
    assert N.ingest_names([" Total Price ($) ", "a-b", "A  B"]) == ["total_price_", "ab", "a_b"]


def test_clean_names():
    assert N.clean_names(["a-b.c", "2nd", "x", "$$", "a___b", "ingested_at"]) == [
        "a_b_c", "col_2nd", "x", "col_3", "a__b", "ingested_at",
    ]


def test_name_collisions_get_suffixes():
    assert N.ingest_names(["a b", "A_b", "a_b_1"]) == ["a_b", "a_b_2", "a_b_1"]
    assert len(set(N.clean_names(["a", "A", "a "]))) == 3


# null tokens, gaps


def test_null_tokens(spark):
    df = one(spark, ["", " ", "NULL", "none", "x", "  ", "Na"])
    assert by_id(M.replace_null_tokens(df)) == [None, None, None, None, "x", "  ", "Na"]


def test_null_token_keeps_null(spark):
    assert by_id(M.replace_null_tokens(one(spark, ["x", None]))) == ["x", None]


def test_median_fill(spark):
    df = one(spark, [1, 2, 4, 7, 11, None], "int")
    assert by_id(M.impute(df, columns=["v"])) == [1, 2, 4, 7, 11, 4.0]


def test_mode_fill_smallest_on_ties(spark):
    df = one(spark, ["2024-01-02", "2024-01-01", "2024-01-02", "2024-01-01", None]).withColumn("v", F.col("v").cast("date"))
    assert str(by_id(M.impute(df, columns=["v"]))[-1]) == "2024-01-01"


def test_mode_fill_timestamp_and_boolean(spark):
    df = one(spark, [True, None, True, False], "boolean")
    assert by_id(M.impute(df, columns=["v"])) == [True, True, True, False]
    ts = one(spark, ["2024-01-01 10:00:00.5", None]).withColumn("v", F.col("v").cast("timestamp_ntz"))
    assert by_id(M.impute(ts, columns=["v"]))[1] == datetime(2024, 1, 1, 10, 0, 0, 500000)


def test_nan_is_missing(spark):
    df = one(spark, [1.0, float("nan"), 3.0], "double")
    assert by_id(M.impute(df, columns=["v"])) == [1.0, 2.0, 3.0]
    assert A.completeness(df.select("v")).first()["non_null_count"] == 2


def test_drop_rows_ignores_metadata(spark):
    df = spark.createDataFrame([(None, None, "s"), ("x", None, "s")], "a string, b string, data_source string")
    assert M.drop_empty_rows(df).count() == 1


def test_forward_fill(spark):
    rows = [(k, i, None if i % 3 else i) for k in ("a", "b") for i in range(100)] + [(None, 1, None), (None, 2, 5)]
    df = spark.createDataFrame(rows, "k string, i int, v int")
    got = {(r["k"], r["i"]): r["v"] for r in M.forward_fill(df, ["v"], ["i"], ["k"]).collect()}
    assert got == {(k, i): i - i % 3 for k in ("a", "b") for i in range(100)} | {(None, 1): None, (None, 2): 5}
    with pytest.raises(ValueError):
        M.forward_fill(df, ["v"], ["i"], [])


# text and types


def test_text_rules(spark):
    df = one(spark, ["  Ab ", "", "nan", None, "\tX", " Y "])
    assert by_id(X.clean_text(df)) == ["ab", "unknown", "unknown", "unknown", "x", "y"]


def test_datetime_all_or_nothing(spark):
    df = spark.createDataFrame([("2024-01-01", "2024-01-01", None), ("2024-01-02", "unknown", None)], "a string, b string, c string")
    out = X.coerce_datetimes(df)
    assert dict(out.dtypes) == {"a": "timestamp_ntz", "b": "string", "c": "string"}
    assert values(out, "a") == [datetime(2024, 1, 1), datetime(2024, 1, 2)]


def test_datetime_checks_rows_beyond_the_probe(spark):
    good = spark.range(3000).select(F.lit("2024-01-01").alias("v"))
    bad = good.unionAll(spark.range(1).select(F.lit("soon").alias("v")))
    assert dict(X.coerce_datetimes(good).dtypes)["v"] == "timestamp_ntz"
    assert dict(X.coerce_datetimes(bad).dtypes)["v"] == "string"


def test_datetime_needs_valid_days(spark):
    assert dict(X.coerce_datetimes(one(spark, ["2024-02-30", "2024-01-01"])).dtypes)["v"] == "string"


def test_numeric_coercion(spark):
    assert by_id(X.coerce_numbers(one(spark, ["1", "2", "3", "x"]))) == [1, 2, 3, None]
    assert by_id(X.coerce_numbers(one(spark, ["1", "x", "y", "2"]))) == ["1", "x", "y", "2"]
    assert by_id(X.coerce_numbers(one(spark, ["1e3", ".5", "-2.", " 7 ", "1d", "nan"]))) == [1000, 0.5, -2, 7, None, None]


# outliers


def test_iqr_bounds(spark):
    assert O.iqr_bounds(one(spark, [1, 2, 4, 7, 11], "int"), ["v"]) == {"v": (-5.5, 14.5)}


def test_outlier_removed(spark):
    df = one(spark, [*range(1, 30), 1000], "int")
    assert sorted(values(O.handle_outliers(df, columns=["v"]), "v")) == list(range(1, 30))


def test_outlier_capped(spark):
    df = one(spark, [*range(1, 10), 1000], "int")
    assert by_id(O.handle_outliers(df, columns=["v"])) == [*range(1, 10), 14.5]


def test_removal_drops_missing_values(spark):
    df = one(spark, [*range(1, 30), 1000, None], "int")
    assert O.handle_outliers(df, columns=["v"]).count() == 29


def test_sequential_and_joint(spark):
    rows = [(i, i) for i in range(1, 30)] + [(1000, 40)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert O.handle_outliers(df).count() == 29
    wide = spark.createDataFrame([(i, i) for i in range(1, 30)] + [(1000, 9999)], "a int, b int")
    assert O.handle_outliers(wide).count() == 29
    assert O.handle_outliers(wide, replace(DEFAULTS, outlier_mode="joint")).count() == 29


def test_later_columns_see_rows_left_over(spark):
    # 44 is inside b's bounds on all 30 rows and outside on the 29 left by a
    rows = [(i, i) for i in range(1, 29)] + [(29, 44), (1000, 9999)]
    df = spark.createDataFrame(rows, "a int, b int")
    assert O.handle_outliers(df).count() == 28
    assert O.handle_outliers(df, replace(DEFAULTS, outlier_mode="joint")).count() == 29


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(5, None)] * 4, "a int, b int")
    assert O.handle_outliers(df).count() == 4


# duplicates and assessment


def test_duplicates_ignore_metadata(spark):
    rows = [(1, "x", "t1"), (1, "x", "t2"), (2, None, "t3"), (2, None, "t4"), (2, "y", "t5")]
    df = spark.createDataFrame(rows, "a int, b string, ingested_at string")
    assert D.drop_duplicates(df).count() == 3
    kept = {(r["a"], r["b"]): r["ingested_at"] for r in D.drop_duplicates(df, order_by=["ingested_at"]).collect()}
    assert kept == {(1, "x"): "t1", (2, None): "t3", (2, "y"): "t5"}
    score = A.uniqueness_score(df).first()
    assert (score["duplicate_rows"], score["score"], score["threshold_met"]) == (2, 60.0, False)
    flagged = D.flag_duplicates(df, ["ingested_at"]).where("is_duplicate").collect()
    assert sorted(r["ingested_at"] for r in flagged) == ["t2", "t4"]


def test_flag_duplicates_with_missing_order(spark):
    df = spark.createDataFrame([("x", None), ("x", 1), ("y", 2)], "t string, i int")
    assert {(r["t"], r["i"]): r["is_duplicate"] for r in D.flag_duplicates(df, ["i"], ["t"]).collect()} == {
        ("x", None): False, ("x", 1): True, ("y", 2): False,
    }


def test_map_columns_can_be_deduplicated(spark):
    df = spark.sql("SELECT map('a', 1) AS m, id % 2 AS k FROM range(4)")
    assert D.drop_duplicates(df).count() == 2


def test_custom_check(spark):
    even = C.Check("even", "numeric", 30, lambda name, c, ctx: f"{c} % 2 = 0", "%d even values", "{found} > {present} * 0.5")
    got = A.consistency(one(spark, [2, 4, 5], "int"), columns=["v"], checks=(*C.BUILT_IN, even)).first()
    assert (got["score"], got["issues"]) == (70, ["2 even values"])


def test_long_text_and_nested_duplicates(spark):
    long = "a" * 500
    df = spark.createDataFrame([(long, [1]), (long, [1]), (long + "b", [1]), (None, None)], "t string, a array<int>")
    assert D.drop_duplicates(df).count() == 3
    unique = {r["column"]: r["unique_values"] for r in A.uniqueness(df).collect()}
    assert unique == {"t": 2, "a": 1}


def test_completeness_and_validity(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x"), (4, "y")], "a int, b string")
    assert {r["column"]: r["completeness_percentage"] for r in A.completeness(df).collect()} == {"a": 75.0, "b": 50.0}
    score = A.completeness_score(df).first()
    assert (score["score"], score["threshold_met"]) == (62.5, False)
    assert {r["column"]: r["validity_percentage"] for r in A.validity(df).collect()} == {"a": 75.0, "b": 50.0}


def test_text_consistency(spark):
    got = A.consistency(one(spark, ["abc", "ABC", "Abc", " x", "1"]), columns=["v"]).first()
    assert got["score"] == 70
    assert got["issues"] == ["Inconsistent text casing", "1 values with leading/trailing whitespace"]


def test_numeric_consistency(spark):
    got = A.consistency(one(spark, [*range(1, 20), 1000, 1000], "int"), columns=["v"]).first()
    assert (got["score"], got["issues"]) == (75, ["2 extreme outliers detected"])


def test_datetime_consistency(spark):
    df = one(spark, ["2024-01-01", "2025-01-01", "1899-12-31"]).withColumn("v", F.col("v").cast("date"))
    got = A.consistency(df, columns=["v"], now="2024-06-01 00:00:00").first()
    assert got["score"] == 65 and len(got["issues"]) == 2


def test_other_types_are_consistent(spark):
    assert A.consistency(one(spark, [True, None], "boolean"), columns=["v"]).first()["score"] == 100


def test_report_of_empty_and_of_metadata_only_tables(spark):
    empty = spark.createDataFrame([], "a int, b string")
    row = A.quality_report(empty).first()
    assert (row["total_rows"], row["completeness"]["score"], row["uniqueness"]["score"], row["validity"]["score"]) == (0, 0.0, 100.0, 100.0)
    bare = spark.createDataFrame([("t", "s")], "ingested_at string, data_source string")
    assert A.quality_report(bare).first()["overall_score"] == 100.0
    assert P.row_summary(empty, empty).first()["removal_percentage"] == 0.0


def test_overall_score_and_recommendations(spark):
    row = spark.createDataFrame(
        [(62.5, False, 60.0, False, 70.0, False, 62.5, False)],
        "completeness_score double, completeness_met boolean, uniqueness_score double, uniqueness_met boolean, "
        "consistency_score double, consistency_met boolean, validity_score double, validity_met boolean",
    )
    texts = row.select(A.recommendations().alias("r")).first()["r"]
    assert texts[0] == "Improve data completeness (current: 62.5%, target: 80%)"
    assert texts[1] == "Address duplicate records (current uniqueness: 60.0%, target: 95%)"
    assert len(texts) == 4


# exploration


def test_describe(spark):
    got = E.describe(one(spark, [1, 2, 3, 4], "int"), ["v"]).first()
    assert (got["count"], got["mean"], round(got["std"], 6)) == (4, 2.5, 1.290994)
    assert [got[c] for c in ("min", "p25", "p50", "p75", "max")] == [1, 1.75, 2.5, 3.25, 4]


def test_correlation_pairwise_and_constant(spark):
    df = spark.createDataFrame([(1, 2), (2, None), (3, 5), (4, 9)], "x int, y int")
    assert round(E.correlation_pairs(df).first()["corr"], 6) == 0.963123
    flat = spark.createDataFrame([(1, 0.1), (2, 0.1), (3, 0.1)], "x int, y double")
    assert E.correlation_pairs(flat).first()["corr"] is None
    matrix = {(r["var_x"], r["var_y"]): r["corr"] for r in E.correlation_matrix(flat).collect()}
    assert matrix == {("x", "x"): 1.0, ("y", "y"): None, ("x", "y"): None, ("y", "x"): None}


def test_correlation_far_from_zero(spark):
    df = spark.range(1000).selectExpr("1e9 + id AS x", "1e9 + 2 * id AS y")
    assert abs(E.correlation_pairs(df).first()["corr"] - 1) < 1e-12


def test_trend(spark):
    df = spark.createDataFrame([(1, 2), (2, None), (3, 5), (4, 9)], "x int, y int")
    got = E.linear_trend(df, "x", "y").first()
    assert (round(got["slope"], 6), round(got["intercept"], 6)) == (2.214286, -0.571429)
    line = E.trend_line(df, "x", "y").orderBy("point").collect()
    assert len(line) == 100 and line[0]["x"] == 1 and line[-1]["x"] == 4


def test_histogram_edges(spark):
    got = E.histogram(one(spark, [0.0, 10.0], "double"), "v", 5).orderBy("bin").collect()
    assert [r["n"] for r in got] == [1, 0, 0, 0, 1]
    assert [(r["bin"], r["n"]) for r in E.histogram(one(spark, [3.0, 3.0], "double"), "v").collect()] == [(1, 2)]
    assert E.histogram(one(spark, [None], "double"), "v").count() == 0


def test_recency(spark):
    df = one(spark, ["2024-01-01 00:00:00"]).withColumn("cleaned_at", F.col("v").cast("timestamp_ntz"))
    far = "2024-03-01 00:00:00"
    assert E.recent(df, "Last Day", far).count() == 1
    assert E.recent(df, "Last Day", far, fallback_to_all=False).count() == 0
    assert E.recent(df, "Last Day", "2024-01-01 12:00:00", fallback_to_all=False).count() == 1
    assert E.recent(df, "Whenever", far).count() == 1


def test_deep_row_slice_equals_shallow(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.col("id").alias("other"))
    want = [r["k"] for r in E.row_slice(df, ["k"], 1234, 100).collect()]
    monkeypatch.setattr(E, "_OFFSET_IN_MEMORY", 0)
    got = [r["k"] for r in E.row_slice(df, ["k"], 1234, 100, ["k"]).collect()]
    assert want == list(range(1234, 1334)) and got == want


def test_human_units(spark):
    assert by_id(one(spark, [999, 1500, 2500000, 1150], "bigint").withColumn("v", S.human_number(F.col("v")))) == ["999", "1.5K", "2.5M", "1.1K"]
    assert by_id(one(spark, [10, 1536, 1024**4 * 2], "bigint").withColumn("v", S.human_bytes(F.col("v")))) == ["10.0 B", "1.5 KB", "2.0 TB"]


def test_one_decimal_rounds_like_binary_text(spark):
    xs = [i / 1000 for i in range(0, 40000, 7)] + [0.25, 0.75, 1.25, 1.15, 2.675, 0.05, 99.95, 0.3]
    df = one(spark, xs, "double")
    assert by_id(df.withColumn("v", S.one_decimal(F.col("v")))) == [f"{x:.1f}" for x in xs]


def test_profiling_and_detail(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 4)], "t string, n int")
    card = E.profiling_card(df, "t").first()
    assert (card["most_common"], card["unique_values"], card["null_count"]) == ("a", 2, 1)
    card = E.profiling_card(df, "n").first()
    assert (card["mean_value"], card["std_deviation"]) == (2.33, 1.53)
    assert E.column_detail(df, "n")[1].first()["count"] == 3


def test_flatten(spark):
    df = spark.sql("SELECT 1 AS a, named_struct('b', 2, 'c', named_struct('d', 'x')) AS s, array(1, 2) AS l")
    assert E.flatten(df).first().asDict() == {"a": 1, "s_b": 2, "s_c_d": "x", "l": "[1,2]"}


# status


def test_new_files(spark):
    state = spark.createDataFrame([("f1", "t1"), ("f2", "t1")], "name string, last_modified string")
    files = spark.createDataFrame([("f1", "t1"), ("f2", "t2"), ("f3", "t1")], "name string, last_modified string")
    assert sorted(values(St.new_files(files, state), "name")) == ["f2", "f3"]


def test_unprocessed_files(spark):
    log = spark.createDataFrame(
        [("f1", "clean", "processing", 1), ("f1", "clean", "completed", 2), ("f2", "clean", "completed", 1), ("f2", "clean", "error", 2)],
        "file string, stage string, status string, ts int",
    )
    files = spark.createDataFrame([("f1",), ("f2",), ("f3",)], "file string")
    assert sorted(values(St.unprocessed_files(files, log), "file")) == ["f2", "f3"]


@pytest.mark.parametrize(
    ("rows", "verdict"),
    [
        ([("ingest", "completed", 1), ("clean", "completed", 1)], "healthy"),
        ([("ingest", "completed", 1), ("clean", "completed", 1), ("clean", "error", 2)], "error"),
        ([("ingest", "completed", 1)], "warning"),
    ],
)
def test_pipeline_status(spark, rows, verdict):
    log = spark.createDataFrame(rows, "stage string, status string, ts int")
    assert St.pipeline_status(log).first()["overall"] == verdict


# flows


def test_row_completeness(spark):
    df = spark.createDataFrame([(1, "x", None)], "a int, b string, c string")
    assert P.row_completeness(df).first()["completeness_score"] == 66.67


def test_normalise(spark):
    df = spark.createDataFrame(
        [("x", "N/A", None), ("", None, None)], "`A b` string, `c-d` string, e string"
    )
    out = normalise(df, "src", now="2024-01-01 00:00:00", file="f.csv")
    assert out.columns == ["a_b", "ingested_at", "data_source", "source_file"]
    assert [r["a_b"] for r in out.collect()] == ["x"]


def test_clean_is_idempotent_on_names_and_text(spark):
    df = spark.createDataFrame(
        [("  Ab", 1.0), ("cD ", 2.0), ("cD ", 2.0), (None, None), ("x", 2.5), ("y", 1.5)], "`First Name` string, amount double"
    )
    once = P.clean(df, now="2024-01-01 00:00:00")
    again = P.clean(once.drop("cleaned_at", "completeness_score"), now="2024-01-01 00:00:00")
    assert once.columns == ["first_name", "amount", "cleaned_at", "completeness_score"]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect()))
    assert once.count() == 5
    summary = P.cleaning_summary(df, once, now="2024-01-01 00:00:00").first()
    assert (summary["original_rows"], summary["cleaned_rows"], summary["rows_removed"]) == (6, 5, 1)
    assert summary["quality_report"]["uniqueness"]["threshold_met"] is False
    assert summary["column_stats"]["amount"]["null_count"] == 0


def test_infer_before_impute(spark):
    df = one(spark, ["2024-01-01", None, "2024-01-03"])
    late = P.clean(df, now="2024-01-01 00:00:00")
    early = P.clean(df, replace(DEFAULTS, infer_before_impute=True), now="2024-01-01 00:00:00")
    assert dict(late.dtypes)["v"] == "string" and dict(early.dtypes)["v"] == "timestamp_ntz"
