"""Exact duplicates by recipes of content-defined chunks.

A text is cut where its content says so (``chunks``), so equal texts are cut alike.
Each distinct chunk gets an identifier; that no two chunks share one is checked on the
data, and chunks that do are told apart by an ordinal.  From then on a document is its
ordered list of identifiers: grouping and comparing move these lists, never the text.

All of it is DataFrame expressions.  NULL text counts as empty; an empty text has an
empty recipe and equals other empty texts.  Of equal texts the row with the largest
``doc_id`` stays (NULL is the smallest), of repeated rows exactly one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableward.llm.common import free_name, join_facts
from tableward.session import stage

#: Characters after which a chunk ends at the next line or sentence end, and after which it ends anywhere.
LEAST, MOST = 1024, 8192


def chunks(text: Column, least: int = LEAST, most: int = MOST) -> Column:
    """The pieces of a text, whose concatenation is the text."""
    cut = f"(?s).{{{least},{most}}}?(?<=[\\n.])|.{{1,{most}}}"
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(cut), F.lit(0))


def sha256_id(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def shared_ids(docs: DataFrame, text: str = "text", identify: Callable[[Column], Column] = sha256_id) -> DataFrame:
    """Chunks whose identifier belongs to several chunks: ``id, chunk, ordinal``; normally none."""
    pieces = docs.select(F.explode(chunks(F.col(text))).alias("chunk")).select(identify(F.col("chunk")).alias("id"), "chunk")
    distinct = pieces.distinct()  # the one place where text is moved, each chunk once per task that has it
    several = distinct.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    ordinal = F.row_number().over(Window.partitionBy("id").orderBy("chunk"))
    return distinct.join(several, "id", "left_semi").withColumn("ordinal", ordinal)


def recipe_keys(
    docs: DataFrame, text: str = "text", identify: Callable[[Column], Column] = sha256_id, row: str = "_row",
) -> DataFrame:
    """``docs`` with ``_recipe``, the list of verified chunk identifiers.  ``row`` names a unique column."""
    listed = docs.withColumn("_recipe", F.transform(chunks(F.col(text)), identify))
    shared = shared_ids(docs, text, identify)
    if shared.isEmpty():
        return listed
    shared = stage(shared, "shared-ids")
    pieces = docs.select(row, F.posexplode(chunks(F.col(text))).alias("pos", "chunk")).withColumn("id", identify(F.col("chunk")))
    fixes = (
        pieces.join(shared, ["id", "chunk"])
        .groupBy(row).agg(F.map_from_entries(F.collect_list(F.struct("pos", "ordinal"))).alias("_fixes"))
    )
    suffix = lambda pos: F.coalesce(F.concat(F.lit("+"), F.element_at("_fixes", pos).cast("string")), F.lit(""))
    told_apart = F.transform("_recipe", lambda v, pos: F.concat(v.cast("binary"), suffix(pos).cast("binary")))
    return listed.join(fixes, row, "left").withColumn("_recipe", told_apart).drop("_fixes")


def groups(keyed: DataFrame, doc_id: str, row: str) -> DataFrame:
    """One row per recipe that occurs more than once: its size and the row that stays."""
    last = F.max(F.struct(F.col(doc_id).alias("id"), F.col(row).alias("row")))
    return (
        keyed.groupBy("_recipe").agg(last.alias("last"), F.count("*").alias("size")).where("size > 1")
        .select("_recipe", "size", F.col("last.id").alias("keep_id"), F.col("last.row").alias("keep_row"))
    )


def judged(keyed: DataFrame, doc_id: str = "doc_id", row: str = "_row") -> DataFrame:
    """``keyed`` (a written table) with ``keep_id``, ``group_size`` and ``kept`` instead of its recipe."""
    found = join_facts(keyed, F.col("_recipe"), groups(keyed, doc_id, row), "_recipe", F.col(row), "_group")
    alone = F.col("_group").isNull()
    return found.withColumns(
        {
            "keep_id": F.when(alone, F.col(doc_id)).otherwise(F.col("_group.keep_id")),
            "group_size": F.coalesce("_group.size", F.lit(1).cast("long")),
            "kept": alone | (F.col(row) == F.col("_group.keep_row")),
        }
    ).drop("_group", "_recipe")


def exact_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", identify: Callable[[Column], Column] = sha256_id,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    # The row number is written once and only read after that, so it is the same in all that follows.
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).withColumn("_row", F.monotonically_increasing_id())
    keyed = recipe_keys(slim, "text", identify).withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256)).drop("text")
    found = judged(stage(keyed, "recipes"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def without_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    row = free_name(docs, "_row")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    slim = numbered.select(F.col(row).alias("_row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    keyed = stage(recipe_keys(slim, "text").drop("text"), "recipes")
    dropped = judged(keyed).where(~F.col("kept")).select(F.col("_row").alias(row))
    return numbered.join(dropped, row, "left_anti").drop(row)
