"""A mix of sources with target weights.

A pass over the documents gives each one's size in words and the words of each source.
Targets share all words by weight, but none exceeds ``MOST_REPEATS`` times its source:
what is over is shared again among the others.  A source's rate is its target divided by
its words; a document is taken floor(rate) times, and once more with a probability of
what is left of the rate.  That draw is a hash of a seed and the document's id, so reruns
agree, and a rate between two whole numbers is met on average.

NULL text has size 0; NULL is a source of its own, after all others.  A document without
id draws by its text.  Sources without words have target 0.  Sizes and targets are
tables; only one-row sums reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableward.llm.common import free_name, join_facts, words_of
from tableward.session import stage

#: Weights of the sources in order, repeating; how often a source may be repeated; the draw's seed.
WEIGHTS, MOST_REPEATS, SEED = (5, 2, 1), 3, "mix-1"


def size(text: Column) -> Column:
    """The number of words."""
    return F.size(words_of(text)).cast("long")


def draw(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A number from 0 up to 1 that follows from the seed and the document's id."""
    name = F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), name)), 1, 12), 16, 10).cast("double") / float(16**12)


def ranked(sources: DataFrame, name: str) -> DataFrame:
    """``sources`` (one row each) with ``rank`` from 0 by code point, NULL last.

    Range partitions count themselves; a row's rank is its place there plus the counts of
    the partitions before, so no task sorts all sources.
    """
    order = (F.col(name).isNull(), F.col(name))
    dealt = stage(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "sources")
    counted = dealt.groupBy("part").agg(F.count("*").alias("rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over one row per partition
    offsets = counted.select("part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("offset"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order))
    return dealt.withColumn("place", place).join(offsets, "part").withColumn("rank", F.col("offset") + F.col("place") - 1).drop(
        "part", "place", "offset"
    )


def targets(sources: DataFrame, name: str, weights: tuple[int, ...] = WEIGHTS, most: float = MOST_REPEATS) -> DataFrame:
    """One row per source with ``source_size`` and ``target``, from a table of ``name, source_size``.

    Each round caps the sources whose share is above ``most`` times their size; what they
    leave is shared by weight among the others, until a round caps none.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    listed = stage(ranked(sources, name).withColumn("weight", weight).drop("rank"), "weights")
    cap = F.col("source_size") * F.lit(most)
    total = listed.agg(F.sum("source_size")).first()[0] or 0
    level, capped = 0.0, -1
    while True:
        full = (cap < level * F.col("weight")) if capped >= 0 else F.lit(False)
        got = listed.agg(
            F.sum(F.when(full, cap).otherwise(0)).alias("given"), F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight"),
            F.sum(full.cast("long")).alias("capped"),
        ).first()
        if not got["weight"] or got["capped"] == capped:
            break
        capped, level = got["capped"], (total - got["given"]) / got["weight"]
    target = F.least(cap.cast("double"), F.lit(float(level)) * F.col("weight"))
    return listed.select(name, "source_size", target.alias("target"))


def planned(sized: DataFrame, source: str = "source", spread: str = "draw", into: str = "_plan") -> DataFrame:
    """Adds the struct ``into`` of ``source_size, target`` to a written table with ``source`` and ``size``."""
    sources = sized.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    return join_facts(sized, F.col(source), targets(sources, "source"), "source", F.col(spread), into)


def copies(source_size: Column, target: Column, drawn: Column) -> Column:
    """How often a document is taken."""
    rate = F.when(source_size > 0, target / source_size).otherwise(F.lit(0.0))
    return (F.floor(rate) + (drawn < rate - F.floor(rate)).cast("long")).cast("long")


def mix_sizes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken`` (words), ``copies``."""
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size(F.col(text)).alias("size"),
        draw(F.col(doc_id), F.col(text)).alias("draw"),
    )
    sized = stage(sized, "sizes")  # the texts are read once and never shuffled
    n = copies(F.col("_plan.source_size"), F.col("_plan.target"), F.col("draw"))
    return planned(sized).select(
        "doc_id", "size", "_plan.source_size", "_plan.target", (n * F.col("size")).alias("taken"), n.alias("copies")
    )


def mixed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken."""
    plan, times = free_name(docs, "_plan"), free_name(docs, "_times")
    sized = stage(docs.select(F.col(source).alias("source"), size(F.col(text)).alias("size")), "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    found = join_facts(docs, F.col(source), targets(sources, "source"), "source", F.xxhash64(doc_id, text), plan)
    n = copies(F.col(f"{plan}.source_size"), F.col(f"{plan}.target"), draw(F.col(doc_id), F.col(text)))
    taken = found.withColumn(times, n).where(F.col(times) > 0)
    return taken.withColumn(times, F.explode(F.array_repeat(F.lit(0), F.col(times).cast("int")))).select(*docs.columns)
