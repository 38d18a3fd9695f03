"""Quality assessment on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableward.functions.columns import TEXT, columns_of_class
from tableward.operators import assess as A
from tableward.operators import checks as C
from tableward.operators import sketches as S
from tableward.operators.profile import distinct_rows
from tableward.registry.base import (
    DIRTY_KINDS, DIRTY_SQL, LINEITEM_NUMBERS, NOW, dirty, query, rounded, table, union,
)

# -- SQL pieces --------------------------------------------------------------


def pct(part: str, whole: str, empty: float) -> str:
    return f"CASE WHEN {whole} = 0 THEN CAST({empty} AS DOUBLE) ELSE CAST({part} AS DOUBLE) / {whole} * 100 END"


def profile_select(name: str, kind: str, data_type: str, source: str) -> str:
    if kind == "numeric":
        rest = (
            f"CAST(min({name}) AS DOUBLE) AS min_value, CAST(max({name}) AS DOUBLE) AS max_value, "
            f"round(avg(CAST({name} AS DOUBLE)), 4) AS mean_value, round(stddev_samp(CAST({name} AS DOUBLE)), 4) AS std_deviation, "
        )
    else:
        rest = (
            "CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value, "
            "CAST(NULL AS DOUBLE) AS mean_value, CAST(NULL AS DOUBLE) AS std_deviation, "
        )
    if kind == "text":
        rest += (
            f"round(avg(length({name})), 4) AS avg_length, CAST(min(length({name})) AS BIGINT) AS min_length, "
            f"CAST(max(length({name})) AS BIGINT) AS max_length"
        )
    else:
        rest += "CAST(NULL AS DOUBLE) AS avg_length, CAST(NULL AS BIGINT) AS min_length, CAST(NULL AS BIGINT) AS max_length"
    return (
        f"SELECT '{name}' AS \"column\", '{data_type}' AS data_type, count(*) AS total_count, "
        f"count({name}) AS non_null_count, count(*) - count({name}) AS null_count, "
        f"count(DISTINCT {name}) AS unique_values, {rest} FROM {source}"
    )


def issue_list(*pairs: tuple[str, str]) -> str:
    """Messages of the fired conditions, joined by '; '."""
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {cond} THEN {text} END" for cond, text in pairs) + ")"


def text_check(name: str, source: str) -> str:
    mixed = f"count(*) FILTER (NOT ({name} = lower({name}) AND {name} <> upper({name})) AND NOT ({name} = upper({name}) AND {name} <> lower({name})))"
    return f"""SELECT '{name}' AS "column",
      100 - CASE WHEN mixed > n * CAST(0.3 AS DOUBLE) THEN 20 ELSE 0 END - CASE WHEN blanks > 0 THEN 10 ELSE 0 END
          - CASE WHEN empties > 0 THEN 15 ELSE 0 END AS score,
      {issue_list(("mixed > n * CAST(0.3 AS DOUBLE)", "'Inconsistent text casing'"),
                  ("blanks > 0", "concat(blanks, ' values with leading/trailing whitespace')"),
                  ("empties > 0", "concat(empties, ' empty strings')"))} AS issues
      FROM (SELECT count({name}) AS n, {mixed} AS mixed, count(*) FILTER ({name} <> trim({name}, ' ' || chr(9) || chr(10) || chr(13))) AS blanks,
                   count(*) FILTER ({name} = '') AS empties FROM {source})"""


def numeric_check(name: str, source: str) -> str:
    return f"""SELECT '{name}' AS "column", 100 - CASE WHEN far > total * CAST(0.05 AS DOUBLE) THEN 25 ELSE 0 END AS score,
      {issue_list(("far > total * CAST(0.05 AS DOUBLE)", "concat(far, ' extreme outliers detected')"))} AS issues
      FROM (SELECT count(*) AS total, count(*) FILTER ({name} < q1 - 3 * (q3 - q1) OR {name} > q3 + 3 * (q3 - q1)) AS far
            FROM {source}, (SELECT quantile_cont(CAST({name} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({name} AS DOUBLE), 0.75) AS q3 FROM {source}) q)"""


def date_check(name: str, source: str, now: str) -> str:
    return f"""SELECT '{name}' AS "column", 100 - CASE WHEN ahead > 0 THEN 20 ELSE 0 END - CASE WHEN old > 0 THEN 15 ELSE 0 END AS score,
      {issue_list(("ahead > 0", "concat(ahead, ' future dates detected')"), ("old > 0", "concat(old, ' dates before 1900')"))} AS issues
      FROM (SELECT count(*) FILTER ({name} > TIMESTAMP '{now}') AS ahead, count(*) FILTER ({name} < TIMESTAMP '1900-01-01') AS old FROM {source})"""


def other_check(name: str, source: str) -> str:
    return f"SELECT '{name}' AS \"column\", 100 AS score, '' AS issues FROM (SELECT count(*) FROM {source})"


def dirty_checks() -> str:
    makers = {
        "text": text_check, "numeric": numeric_check, "boolean": other_check,
        "datetime": lambda n, s: date_check(n, s, NOW),
    }
    return union(makers[kind](name, "dirty") for name, (kind, _) in DIRTY_KINDS.items())


DIRTY_SCORES = f"""{DIRTY_SQL}, checks AS ({dirty_checks()}),
 held AS ({union(f"SELECT count(*) AS total, count({n}) AS present FROM dirty" for n in DIRTY_KINDS)}),
 parts AS (SELECT
   (SELECT count(*) FROM dirty) AS total_rows,
   (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS distinct_rows,
   (SELECT CAST(sum(present) AS DOUBLE) / sum(total) * 100 FROM held) AS comp,
   (SELECT avg(CAST(present AS DOUBLE) / total * 100) FROM held) AS vali,
   (SELECT avg(score) FROM checks) AS cons),
 scores AS (SELECT total_rows, {len(DIRTY_KINDS)} AS total_columns, total_rows - distinct_rows AS duplicate_rows,
   round(comp, 2) AS completeness_score, comp >= 80 AS completeness_met,
   round(CAST(distinct_rows AS DOUBLE) / total_rows * 100, 2) AS uniqueness_score,
   CAST(distinct_rows AS DOUBLE) / total_rows * 100 >= 95 AS uniqueness_met,
   round(cons, 2) AS consistency_score, cons >= 90 AS consistency_met,
   round(vali, 2) AS validity_score, vali >= 85 AS validity_met FROM parts)
"""
_OVERALL = "round((completeness_score + uniqueness_score + consistency_score + validity_score) / 4, 4) AS overall_score"
_MESSAGES = union(
    f"SELECT {i} AS place, concat('{lead}', printf('%.1f', {n}_score), '%, target: {goal}%)') AS recommendation FROM scores WHERE NOT {n}_met"
    for i, (n, lead, goal) in enumerate(
        (
            ("completeness", "Improve data completeness (current: ", 80),
            ("uniqueness", "Address duplicate records (current uniqueness: ", 95),
            ("consistency", "Improve data consistency (current: ", 90),
            ("validity", "Improve data validity (current: ", 85),
        )
    )
)
_RECOMMENDATIONS = f"""found AS ({_MESSAGES}), texts AS (
  SELECT place, recommendation FROM found
  UNION ALL SELECT 9, 'Data quality meets all thresholds' WHERE NOT EXISTS (SELECT 1 FROM found))"""


def joined_issues(df):
    return df.withColumn("issues", F.array_join("issues", "; "))


# -- queries -----------------------------------------------------------------


@query(DIRTY_SQL + union(profile_select(n, k, t, "dirty") for n, (k, t) in DIRTY_KINDS.items()))
def column_profile(spark, sf_dir):
    return rounded(A.column_profiles(dirty(spark, sf_dir)), 4, "mean_value", "std_deviation", "avg_length")


@query(
    union(
        [profile_select(n, "numeric", "int" if n == "l_linenumber" else "bigint" if n.endswith("key") else "double", "lineitem") for n in LINEITEM_NUMBERS]
        + [profile_select(n, "text", "string", "lineitem") for n in ("l_returnflag", "l_linestatus")]
        + [profile_select("l_shipdate", "datetime", "timestamp_ntz", "lineitem")]
    )
)
def column_profile_lineitem(spark, sf_dir):
    return rounded(A.column_profiles(table(spark, sf_dir, "lineitem")), 4, "mean_value", "std_deviation", "avg_length")


@query(
    DIRTY_SQL
    + union(
        f"SELECT '{n}' AS \"column\", count(*) AS total_count, count({n}) AS non_null_count, "
        f"round({pct(f'count({n})', 'count(*)', 0)}, 2) AS completeness_percentage FROM dirty"
        for n in DIRTY_KINDS
    )
)
def completeness(spark, sf_dir):
    return A.completeness(dirty(spark, sf_dir))


@query(DIRTY_SCORES + "SELECT completeness_score AS score, completeness_met AS threshold_met FROM scores")
def completeness_score(spark, sf_dir):
    return A.completeness_score(dirty(spark, sf_dir))


@query(
    DIRTY_SQL
    + union(
        f"SELECT '{n}' AS \"column\", count(DISTINCT {n}) AS unique_values, count({n}) AS total_values, "
        f"round({pct(f'count(DISTINCT {n})', f'count({n})', 0)}, 2) AS uniqueness_percentage FROM dirty"
        for n in DIRTY_KINDS
    )
)
def uniqueness(spark, sf_dir):
    return A.uniqueness(dirty(spark, sf_dir))


@query(DIRTY_SCORES + "SELECT total_rows, duplicate_rows, uniqueness_score AS score, uniqueness_met AS threshold_met FROM scores")
def uniqueness_score(spark, sf_dir):
    return A.uniqueness_score(dirty(spark, sf_dir))


_DISTINCT_DOCS = ("doc_id", "text", "lang", "source", "n_chars")


@query(
    union(
        f"SELECT '{n}' AS \"column\", count(DISTINCT {n}) AS unique_values, count({n}) AS total_values, "
        f"round({pct(f'count(DISTINCT {n})', f'count({n})', 0)}, 2) AS uniqueness_percentage FROM documents"
        for n in _DISTINCT_DOCS
    )
)
def uniqueness_documents(spark, sf_dir):
    return A.uniqueness(table(spark, sf_dir, "documents"))


@query(
    DIRTY_SQL
    + union(
        f"SELECT '{n}' AS \"column\", count({n}) AS valid_count, count(*) AS total_count, "
        f"round({pct(f'count({n})', 'count(*)', 100)}, 2) AS validity_percentage FROM dirty"
        for n in DIRTY_KINDS
    )
)
def validity(spark, sf_dir):
    return A.validity(dirty(spark, sf_dir))


@query(
    union(
        f"SELECT '{n}' AS \"column\", count(*) FILTER ({rule}) AS valid_count, count(*) AS total_count, "
        f"round({pct(f'count(*) FILTER ({rule})', 'count(*)', 100)}, 2) AS validity_percentage FROM customer"
        for n, rule in (
            ("c_custkey", "c_custkey IS NOT NULL"), ("c_name", "c_name LIKE 'Customer%'"),
            ("c_nationkey", "c_nationkey IS NOT NULL"), ("c_acctbal", "c_acctbal >= 0"),
            ("c_mktsegment", "c_mktsegment IN ('BUILDING', 'MACHINERY')"),
        )
    )
)
def validity_rules(spark, sf_dir):
    rules = {
        "c_name": lambda c: c.like("Customer%"),
        "c_acctbal": lambda c: c >= 0,
        "c_mktsegment": lambda c: c.isin("BUILDING", "MACHINERY"),
    }
    return A.validity(table(spark, sf_dir, "customer"), rules=rules)


@query(DIRTY_SQL + union(text_check(n, "dirty") for n, (k, _) in DIRTY_KINDS.items() if k == "text"))
def text_consistency(spark, sf_dir):
    df = dirty(spark, sf_dir)
    return joined_issues(A.consistency(df, columns=columns_of_class(df, TEXT)))


@query(
    union(
        text_check(n, t)
        for t, names in (("part", ("p_name", "p_brand", "p_type")), ("customer", ("c_name", "c_mktsegment")), ("documents", ("text", "lang", "source")))
        for n in names
    )
)
def text_consistency_tables(spark, sf_dir):
    found = [
        A.consistency(table(spark, sf_dir, t), columns=names)
        for t, names in (("part", ("p_name", "p_brand", "p_type")), ("customer", ("c_name", "c_mktsegment")), ("documents", ("text", "lang", "source")))
    ]
    return joined_issues(found[0].unionAll(found[1]).unionAll(found[2]))


@query(
    DIRTY_SQL
    + union([numeric_check(n, "dirty") for n in ("amount", "spiky")] + [numeric_check("value", "events")])
)
def numeric_consistency(spark, sf_dir):
    soiled = A.consistency(dirty(spark, sf_dir), columns=("amount", "spiky"))
    return joined_issues(soiled.unionAll(A.consistency(table(spark, sf_dir, "events"), columns=("value",))))


@query(union([date_check("o_orderdate", "orders", "1999-06-01 00:00:00"), date_check("ts", "events", "2024-06-01 00:00:00")]))
def datetime_consistency(spark, sf_dir):
    past = A.consistency(table(spark, sf_dir, "orders"), columns=("o_orderdate",), now="1999-06-01 00:00:00")
    return joined_issues(past.unionAll(A.consistency(table(spark, sf_dir, "events"), columns=("ts",), now="2024-06-01 00:00:00")))


@query(DIRTY_SCORES + 'SELECT "column", score, issues FROM checks')
def consistency(spark, sf_dir):
    return joined_issues(A.consistency(dirty(spark, sf_dir), now=NOW))


@query(DIRTY_SCORES + f"SELECT *, {_OVERALL} FROM scores")
def quality_scores(spark, sf_dir):
    return rounded(A.quality_scores(dirty(spark, sf_dir), now=NOW), 4, "overall_score")


@query(DIRTY_SCORES + f"SELECT {_OVERALL} FROM scores")
def overall_score(spark, sf_dir):
    return rounded(A.quality_scores(dirty(spark, sf_dir), now=NOW), 4, "overall_score").select("overall_score")


@query(f"{DIRTY_SCORES}, {_RECOMMENDATIONS} SELECT recommendation FROM texts")
def recommendations(spark, sf_dir):
    scores = A.quality_scores(dirty(spark, sf_dir), now=NOW)
    return scores.select(F.explode(A.recommendations()).alias("recommendation"))


@query(
    f"""{DIRTY_SCORES}, {_RECOMMENDATIONS}
    SELECT TIMESTAMP '{NOW}' AS assessment_timestamp, total_rows, total_columns, duplicate_rows,
      completeness_score, uniqueness_score, consistency_score, validity_score, {_OVERALL},
      (SELECT string_agg(recommendation, ' | ' ORDER BY place) FROM texts) AS recommendations,
      CAST({len(DIRTY_KINDS)} AS BIGINT) AS profiled_columns FROM scores"""
)
def quality_report(spark, sf_dir):
    report = A.quality_report(dirty(spark, sf_dir), now=NOW)
    return report.select(
        "assessment_timestamp", "total_rows", "total_columns",
        F.col("uniqueness.duplicate_rows").alias("duplicate_rows"),
        *[F.col(f"{p}.score").alias(f"{p}_score") for p in ("completeness", "uniqueness", "consistency", "validity")],
        F.round("overall_score", 4).alias("overall_score"),
        F.array_join("recommendations", " | ").alias("recommendations"),
        F.size("column_profiles").cast("bigint").alias("profiled_columns"),
    )


@query(
    f"""{DIRTY_SQL}, checks AS ({dirty_checks()}),
      profiles AS ({union(profile_select(n, k, t, "dirty") for n, (k, t) in DIRTY_KINDS.items())})
      SELECT p."column", p.data_type, p.total_count, p.non_null_count, p.null_count, p.unique_values,
      round(CAST(non_null_count AS DOUBLE) / total_count * 100, 2) AS completeness_percentage,
      round({pct("unique_values", "non_null_count", 0)}, 2) AS uniqueness_percentage,
      round(CAST(non_null_count AS DOUBLE) / total_count * 100, 2) AS validity_percentage,
      c.score AS consistency_score, c.issues, min_value, max_value, mean_value, std_deviation, avg_length, min_length, max_length
      FROM profiles p JOIN checks c ON p."column" = c."column" """
)
def quality_table(spark, sf_dir):
    return rounded(
        joined_issues(A.quality_table(dirty(spark, sf_dir), now=NOW)), 4, "mean_value", "std_deviation", "avg_length"
    )


@query(
    """SELECT 'c_acctbal' AS "column", 100 - CASE WHEN neg > 0 THEN 10 ELSE 0 END AS score,
       CASE WHEN neg > 0 THEN concat(neg, ' negative amounts') ELSE '' END AS issues
       FROM (SELECT count(*) FILTER (c_acctbal < 0) AS neg FROM customer)"""
)
def custom_check(spark, sf_dir):
    found = A.consistency(
        table(spark, sf_dir, "customer"), columns=("c_acctbal",), checks=(C.negative_amounts(("c_acctbal",)),)
    )
    return joined_issues(found)


@query(
    f"""SELECT count(*) FILTER (o_totalprice < 50000) AS low_amounts,
      round(CAST(count(*) FILTER (o_totalprice < 50000) AS DOUBLE) / count(*) * 100, 4) AS low_percentage,
      count(*) FILTER (o_orderdate > TIMESTAMP '1999-06-01') AS future_dates,
      round(CAST(count(*) FILTER (o_orderdate > TIMESTAMP '1999-06-01') AS DOUBLE) / count(*) * 100, 4) AS future_percentage
      FROM orders"""
)
def financial_check(spark, sf_dir):
    found = A.amount_and_date_check(
        table(spark, sf_dir, "orders"), "o_totalprice", "o_orderdate", now="1999-06-01 00:00:00", least=50000
    )
    return rounded(found, 4, "low_percentage", "future_percentage")


@query(
    """SELECT count(*) AS total_rows,
       (SELECT count(*) FROM (SELECT DISTINCT l_returnflag, l_linestatus, l_quantity, l_discount FROM lineitem)) AS distinct_rows
       FROM lineitem"""
)
def duplicate_count(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem")
    found = distinct_rows(df, ["l_returnflag", "l_linestatus", "l_quantity", "l_discount"])
    return df.agg(F.count("*").alias("total_rows")).withColumn("distinct_rows", found.scalar())


# Columns of few values, of which a sketch counts every one.
_FEW = ("l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


def _few_sql(name: str) -> str:
    ends = ("NULL", "NULL") if name in ("l_returnflag", "l_linestatus") else (f"min({name})", f"max({name})")
    return (
        f"""SELECT '{name}' AS "column", count(*) AS total_count, count({name}) AS non_null_count, count(DISTINCT {name}) AS unique_values,
        round(100.0 * count(DISTINCT {name}) / count({name}), 6) AS uniqueness, CAST({ends[0]} AS DOUBLE) AS min_value,
        CAST({ends[1]} AS DOUBLE) AS max_value FROM lineitem"""
    )


@query(union(_few_sql(c) for c in _FEW))
def sketch_profile(spark, sf_dir):
    """Sketched in eight parts, then merged; quantiles are held against exact ranks in the tests."""
    kept = S.column_sketches(table(spark, sf_dir, "lineitem").withColumn("part", F.col("l_suppkey") % 8), _FEW, ["part"])
    return rounded(S.sketch_profile(kept).drop("p25", "p50", "p75"), 6, "uniqueness")
