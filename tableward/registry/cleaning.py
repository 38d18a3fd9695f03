"""Cleaning operators on the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from tableward.config import DEFAULTS, NULL_TOKENS
from tableward.functions import names as N
from tableward.operators import dedupe as D
from tableward.operators import missing as M
from tableward.operators import outliers as O
from tableward.operators import textclean as X
from tableward.plans import cleaning as P
from tableward.plans.ingest import normalise
from tableward.registry.base import DIRTY_KINDS, DIRTY_SQL, NOW, dirty, query, rounded, table, union
from tableward.session import stage

_ALL = ", ".join(DIRTY_KINDS)
_TEXT = [n for n, (k, _) in DIRTY_KINDS.items() if k == "text"]
_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)


def swap(changes: dict[str, str], names=tuple(DIRTY_KINDS)) -> str:
    """A select list with some columns replaced."""
    return ", ".join(f"{changes[n]} AS {n}" if n in changes else n for n in names)


def tidy(name: str) -> str:
    return f"CASE WHEN {name} IS NULL OR trim({name}) IN ('', 'nan') THEN 'unknown' ELSE lower(trim({name})) END"


_TOKENLESS = swap({n: f"CASE WHEN {n} IN ({_TOKENS}) THEN NULL ELSE {n} END" for n in _TEXT})
_NUMBER = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def number(name: str) -> str:
    return f"CASE WHEN regexp_matches(trim({name}), '{_NUMBER}') THEN TRY_CAST(trim({name}) AS DOUBLE) END"


def outlier_steps(source: str, columns: list[str], all_columns: list[str], prefix: str = "o") -> tuple[str, str]:
    """Chained CTEs: bounds, then share, then removal or capping, column by column."""
    ctes, current = [], source
    for i, c in enumerate(columns):
        bounds, share, nxt = f"{prefix}b{i}", f"{prefix}s{i}", f"{prefix}{i}"
        ctes.append(
            f"{bounds} AS (SELECT q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lo, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS hi FROM "
            f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {current}))"
        )
        ctes.append(
            f"{share} AS (SELECT lo, hi, count(*) FILTER ({c} < lo OR {c} > hi) AS far, count(*) AS total "
            f"FROM {current}, {bounds} GROUP BY lo, hi)"
        )
        changed = swap(
            {c: f"CASE WHEN far > 0 AND CAST(far AS DOUBLE) / total >= 0.05 AND {c} IS NOT NULL THEN greatest(least(CAST({c} AS DOUBLE), hi), lo) ELSE CAST({c} AS DOUBLE) END"},
            tuple(all_columns),
        )
        ctes.append(
            f"{nxt} AS (SELECT {changed} FROM {current}, {share} "
            f"WHERE far = 0 OR CAST(far AS DOUBLE) / total >= 0.05 OR {c} BETWEEN lo AND hi)"
        )
        current = nxt
    return ",\n".join(ctes), current


def doubles(df, *names):
    return df.withColumns({n: F.col(n).cast("double") for n in names})


# -- duplicates --------------------------------------------------------------


@query(DIRTY_SQL + f"SELECT DISTINCT {_ALL} FROM dirty")
def dedupe(spark, sf_dir):
    return D.drop_duplicates(dirty(spark, sf_dir))


@query("SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def dedupe_text(spark, sf_dir):
    return D.drop_duplicates(table(spark, sf_dir, "documents"), ["text"], order_by=["doc_id"])


@query("SELECT doc_id, lang, n_chars, rn > 1 AS is_duplicate FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents)")
def flag_duplicates(spark, sf_dir):
    return D.flag_duplicates(table(spark, sf_dir, "documents"), ["doc_id"], ["text"]).select(
        "doc_id", "lang", "n_chars", "is_duplicate"
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM (
       SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_quantity) AS rn FROM lineitem)
       WHERE rn = 1"""
)
def keep_first(spark, sf_dir):
    order = ("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return D.keep_first(table(spark, sf_dir, "lineitem"), ["l_partkey"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )


# -- names -------------------------------------------------------------------

_ODD = {" Total Price ($) ": "o_totalprice", "order-key": "o_orderkey", "A  B": "o_custkey", "2nd": "o_orderstatus", "a.b": "o_orderpriority"}


def _odd_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*[F.col(c).alias(odd) for odd, c in _ODD.items()])


@query("SELECT o_totalprice AS total_price_, o_orderkey AS orderkey, o_custkey AS a_b, o_orderstatus AS \"2nd\", o_orderpriority AS ab FROM orders")
def rename_ingest(spark, sf_dir):
    return N.rename_for_ingest(_odd_orders(spark, sf_dir))


@query("SELECT o_totalprice AS total_price_, o_orderkey AS order_key, o_custkey AS a_b, o_orderstatus AS col_2nd, o_orderpriority AS a_b_1 FROM orders")
def rename_clean(spark, sf_dir):
    return N.rename_for_cleaning(_odd_orders(spark, sf_dir))


# -- missing values ----------------------------------------------------------


@query(DIRTY_SQL + f"SELECT {_TOKENLESS} FROM dirty")
def null_tokens(spark, sf_dir):
    return M.replace_null_tokens(dirty(spark, sf_dir))


@query(DIRTY_SQL + f", t AS (SELECT {_TOKENLESS} FROM dirty) SELECT label, flag, sparse FROM t WHERE coalesce(label, CAST(flag AS STRING), sparse) IS NOT NULL")
def drop_null_rows(spark, sf_dir):
    narrow = M.replace_null_tokens(dirty(spark, sf_dir)).select("label", "flag", "sparse")
    return M.drop_empty_rows(narrow)


@query(DIRTY_SQL + f"SELECT {', '.join(n for n in DIRTY_KINDS if n != 'empty_col')} FROM dirty")
def drop_empty_columns(spark, sf_dir):
    return M.drop_empty_columns(dirty(spark, sf_dir))


@query(DIRTY_SQL + f"SELECT {', '.join(n for n in DIRTY_KINDS if n not in ('empty_col', 'sparse'))} FROM dirty")
def drop_sparse_columns(spark, sf_dir):
    return M.drop_sparse_columns(dirty(spark, sf_dir))


@query(DIRTY_SQL + "SELECT event_id, ts, coalesce(amount, (SELECT quantile_cont(amount, 0.5) FROM dirty)) AS amount FROM dirty")
def impute_median(spark, sf_dir):
    return M.impute(dirty(spark, sf_dir).select("event_id", "ts", "amount"))


@query(DIRTY_SQL + "SELECT event_id, ts, coalesce(amount, (SELECT quantile_cont(amount, 0.5) FROM dirty)) AS amount FROM dirty")
def stats_broadcast(spark, sf_dir):
    return M.impute_with_subquery(dirty(spark, sf_dir).select("event_id", "ts", "amount"), "amount")


@query(
    DIRTY_SQL
    + "SELECT event_id, ts, coalesce(flag, (SELECT flag FROM (SELECT flag, count(*) AS n FROM dirty WHERE flag IS NOT NULL GROUP BY flag) ORDER BY n DESC, flag LIMIT 1)) AS flag FROM dirty"
)
def impute_mode(spark, sf_dir):
    return M.impute(dirty(spark, sf_dir).select("event_id", "ts", "flag"))


@query(DIRTY_SQL + "SELECT event_id, ts, coalesce(label, 'unknown') AS label FROM dirty")
def impute_text(spark, sf_dir):
    return M.impute(dirty(spark, sf_dir).select("event_id", "ts", "label"))


@query(
    DIRTY_SQL
    + """SELECT event_id, user_id, ts,
      last_value(label IGNORE NULLS) OVER w AS label, last_value(amount IGNORE NULLS) OVER w AS amount
      FROM base WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
)
def ffill(spark, sf_dir):
    base = D.drop_duplicates(dirty(spark, sf_dir)).select("event_id", "user_id", "ts", "label", "amount")
    return M.forward_fill(base, ["label", "amount"], ["ts", "event_id"], ["user_id"])


# -- text and types ----------------------------------------------------------


@query(DIRTY_SQL + f"SELECT {swap({n: tidy(n) for n in _TEXT})} FROM dirty")
def clean_text(spark, sf_dir):
    return X.clean_text(dirty(spark, sf_dir))


@query(
    "SELECT c_custkey, lower(trim(c_name)) AS c_name, lower(trim(c_mktsegment)) AS c_mktsegment FROM customer"
)
def clean_text_customer(spark, sf_dir):
    return X.clean_text(table(spark, sf_dir, "customer")).select("c_custkey", "c_name", "c_mktsegment")


@query(DIRTY_SQL + "SELECT event_id, ts, CAST(strptime(date_text, '%Y-%m-%d') AS TIMESTAMP) AS date_text, mixed_date_text, few_num_text FROM dirty")
def coerce_datetime(spark, sf_dir):
    narrow = dirty(spark, sf_dir).select("event_id", "ts", "date_text", "mixed_date_text", "few_num_text")
    return X.coerce_datetimes(narrow)


@query("SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS day_text, o_totalprice FROM orders")
def coerce_datetime_orders(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "dd.MM.yyyy").alias("day_text"), "o_totalprice"
    )
    return X.coerce_datetimes(text)


@query(DIRTY_SQL + f"SELECT event_id, ts, {number('num_text')} AS num_text, few_num_text, mixed_date_text FROM dirty")
def coerce_numeric(spark, sf_dir):
    narrow = dirty(spark, sf_dir).select("event_id", "ts", "num_text", "few_num_text", "mixed_date_text")
    return X.coerce_numbers(narrow)


@query("SELECT CAST(l_orderkey AS BIGINT) AS key_text, l_quantity AS quantity_text, l_returnflag AS flag_text, l_linestatus = 'O' AS open_text FROM lineitem")
def reader_types(spark, sf_dir):
    text = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("key_text"),
        F.col("l_quantity").cast("string").alias("quantity_text"),
        F.col("l_returnflag").alias("flag_text"),
        (F.col("l_linestatus") == "O").cast("string").alias("open_text"),
    )
    return X.infer_reader_types(text)


# -- outliers ----------------------------------------------------------------


def _one_step(source: str, column: str, columns: list[str]) -> str:
    ctes, last = outlier_steps(source, [column], columns)
    return f"WITH {ctes} SELECT * FROM {last}"


@query(_one_step("events", "value", ["event_id", "user_id", "value"]))
def outliers_remove(spark, sf_dir):
    return O.handle_outliers(table(spark, sf_dir, "events").select("event_id", "user_id", "value"), columns=["value"])


@query(_one_step("documents", "n_chars", ["doc_id", "lang", "n_chars"]))
def outliers_cap(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return doubles(O.handle_outliers(df, columns=["n_chars"]), "n_chars")


_SEQ_CTES, _SEQ_LAST = outlier_steps("seq", ["amount", "spiky", "doubled"], ["event_id", "ts", "amount", "spiky", "doubled"])


def _sequence(spark, sf_dir):
    unique = D.drop_duplicates(dirty(spark, sf_dir))
    # several passes follow, so the shuffle behind them is run once
    return stage(unique.selectExpr("event_id", "ts", "amount", "spiky", "amount * 2 + event_id AS doubled"))


@query(f"{DIRTY_SQL}, seq AS (SELECT event_id, ts, amount, spiky, amount * 2 + event_id AS doubled FROM base), {_SEQ_CTES} SELECT * FROM {_SEQ_LAST}")
def outliers_sequential(spark, sf_dir):
    return O.handle_outliers(_sequence(spark, sf_dir), columns=["amount", "spiky", "doubled"])


_JOINT = []
for _c in ("amount", "spiky", "doubled"):
    _JOINT.append(
        f"b_{_c} AS (SELECT q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lo, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS hi FROM "
        f"(SELECT quantile_cont({_c}, 0.25) AS q1, quantile_cont({_c}, 0.75) AS q3 FROM seq))"
    )
    _JOINT.append(
        f"s_{_c} AS (SELECT lo, hi, CAST(count(*) FILTER ({_c} < lo OR {_c} > hi) AS DOUBLE) / count(*) AS share FROM seq, b_{_c} GROUP BY lo, hi)"
    )
_JOINT_CHANGES = swap(
    {c: f"CASE WHEN s_{c}.share >= 0.05 AND {c} IS NOT NULL THEN greatest(least({c}, s_{c}.hi), s_{c}.lo) ELSE {c} END" for c in ("amount", "spiky", "doubled")},
    ("event_id", "ts", "amount", "spiky", "doubled"),
)
_JOINT_KEPT = " AND ".join(
    f"(s_{c}.share = 0 OR s_{c}.share >= 0.05 OR {c} BETWEEN s_{c}.lo AND s_{c}.hi)" for c in ("amount", "spiky", "doubled")
)


@query(
    f"{DIRTY_SQL}, seq AS (SELECT event_id, ts, amount, spiky, amount * 2 + event_id AS doubled FROM base), "
    f"{', '.join(_JOINT)} SELECT {_JOINT_CHANGES} FROM seq, s_amount, s_spiky, s_doubled WHERE {_JOINT_KEPT}"
)
def outliers_joint(spark, sf_dir):
    return O.handle_outliers(
        _sequence(spark, sf_dir), replace(DEFAULTS, outlier_mode="joint"), columns=["amount", "spiky", "doubled"]
    )


@query(
    "SELECT 'l_extendedprice' AS \"column\", q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AS lower_bound, q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS upper_bound FROM "
    "(SELECT round(quantile_cont(l_extendedprice, 0.25), 4) AS q1, round(quantile_cont(l_extendedprice, 0.75), 4) AS q3 FROM lineitem)"
)
def iqr_bounds(spark, sf_dir):
    at = O.quartiles(table(spark, sf_dir, "lineitem"), ["l_extendedprice"])
    q1, q3 = F.round("q1", 4), F.round("q3", 4)
    return at.select(
        "column", (q1 - 1.5 * (q3 - q1)).alias("lower_bound"), (q3 + 1.5 * (q3 - q1)).alias("upper_bound")
    )


# -- whole flows -------------------------------------------------------------

_KEPT = [n for n in DIRTY_KINDS if n not in ("sparse", "empty_col")]
_FILLED = {
    "label": tidy("label"),
    "amount": "coalesce(amount, (SELECT quantile_cont(amount, 0.5) FROM base))",
    "flag": "coalesce(flag, (SELECT flag FROM (SELECT flag, count(*) AS n FROM base WHERE flag IS NOT NULL GROUP BY flag) ORDER BY n DESC, flag LIMIT 1))",
    "num_text": number("num_text"),
    "few_num_text": tidy("few_num_text"),
    "date_text": "CAST(strptime(date_text, '%Y-%m-%d') AS TIMESTAMP)",
    "mixed_date_text": tidy("mixed_date_text"),
}
_CLEAN_CTES, _CLEAN_LAST = outlier_steps("filled", ["event_id", "user_id", "amount", "spiky", "num_text"], _KEPT)
_HELD = " + ".join(f"CASE WHEN {n} IS NULL THEN 0 ELSE 1 END" for n in _KEPT)
CLEANED = f"""{DIRTY_SQL}, filled AS (SELECT {swap(_FILLED, tuple(_KEPT))} FROM base), {_CLEAN_CTES},
  cleaned AS (SELECT *, TIMESTAMP '{NOW}' AS cleaned_at, round(CAST({_HELD} AS DOUBLE) / {len(_KEPT)} * 100, 2) AS completeness_score FROM {_CLEAN_LAST})
"""


@query(CLEANED + "SELECT * FROM cleaned")
def full_clean(spark, sf_dir):
    return doubles(P.clean(dirty(spark, sf_dir), now=NOW), "event_id", "user_id")


@query(
    DIRTY_SQL
    + f"SELECT event_id, ts, round(CAST({' + '.join(f'CASE WHEN {n} IS NULL THEN 0 ELSE 1 END' for n in DIRTY_KINDS)} AS DOUBLE) / {len(DIRTY_KINDS)} * 100, 2) AS completeness_score FROM dirty"
)
def row_completeness(spark, sf_dir):
    return P.row_completeness(dirty(spark, sf_dir)).select("event_id", "ts", "completeness_score")


@query(
    CLEANED
    + f"""SELECT a AS original_rows, b AS cleaned_rows, a - b AS rows_removed, round(CAST(a - b AS DOUBLE) / a * 100, 6) AS removal_percentage,
      {len(DIRTY_KINDS)} AS original_columns, {len(_KEPT) + 2} AS cleaned_columns
      FROM (SELECT (SELECT count(*) FROM dirty) AS a, (SELECT count(*) FROM cleaned) AS b)"""
)
def cleaning_summary(spark, sf_dir):
    original = dirty(spark, sf_dir)
    summary = P.cleaning_summary(original, P.clean(original, now=NOW), now=NOW)
    return rounded(
        summary.select("original_rows", "cleaned_rows", "rows_removed", "removal_percentage", "original_columns", "cleaned_columns"),
        6, "removal_percentage",
    )


@query(
    CLEANED
    + union(
        f"SELECT '{n}' AS \"column\", count({n}) AS non_null_count, count(*) - count({n}) AS null_count, count(DISTINCT {n}) AS unique_values FROM cleaned"
        for n in [*_KEPT, "cleaned_at", "completeness_score"]
    )
)
def cleaning_column_stats(spark, sf_dir):
    return P.column_stats(P.clean(dirty(spark, sf_dir), now=NOW)).drop("data_type")


_INGESTED = [n for n in DIRTY_KINDS if n != "empty_col"]


@query(
    f"{DIRTY_SQL}, t AS (SELECT {_TOKENLESS} FROM dirty) SELECT {', '.join(_INGESTED)}, TIMESTAMP '{NOW}' AS ingested_at, "
    "'driver_tables' AS data_source, 'events.parquet' AS source_file FROM t"
)
def ingest_normalise(spark, sf_dir):
    return normalise(dirty(spark, sf_dir), "driver_tables", now=NOW, file="events.parquet")
