"""What the corpus operators share: reading, safe keys, and joins that survive hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: the blank and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
WORD_BREAK = "[ \\x09-\\x0D]+"

#: Parts into which the rows of one key are spread in joins with a table of one row per key.
SALTS = 16


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value: Column, body) -> Column:
    """``body`` applied to ``value``, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text; NULL has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), lambda w: w != "")


def join_facts(rows: DataFrame, key: Column, facts: DataFrame, name: str, spread: Column, into: str, salts: int = SALTS) -> DataFrame:
    """Left-join ``facts``, one row per value of its column ``name``, to rows of which one key may hold a large share.

    The rows of a key are dealt over ``salts`` tasks by the hash of ``spread``; each fact is
    copied as often.  NULL keys match each other.  The other columns of the fact arrive as
    the struct ``into``.  Spark broadcasts the facts instead if their measured size is
    under its own limit.
    """
    at, salt, fact_at, fact_salt = (free_name(rows, n) for n in ("_at", "_salt", "_fact_at", "_fact_salt"))
    left = rows.withColumns({at: key, salt: F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")})
    right = facts.select(
        F.col(name).alias(fact_at), F.struct(*[c for c in facts.columns if c != name]).alias(into),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(fact_salt),
    )
    match = F.col(at).eqNullSafe(F.col(fact_at)) & (F.col(salt) == F.col(fact_salt))
    return left.join(right, match, "left").drop(at, salt, fact_at, fact_salt)
