"""Near duplicates: SimHash fingerprints linked by covering locality-sensitive hashing.

A fingerprint has a bit set where over half the hashes of a text's word shingles have it.
Two fingerprints are linked when at most two bits differ.  Candidates come from seven bit
masks built so that no pair within that radius is missed: bit i carries a vector m(i) of
three bits, and the mask of a vector v keeps the bits whose m(i) has an odd product with
v.  Two differing bits span two dimensions at most, so some v is orthogonal to both, and
its mask blinds them: the pair agrees under it.  A bucket with many fingerprints is
parted again by the same construction on the bits its mask blinds; after three levels
at most six bits are left and a bucket holds 64 fingerprints at most.  So every
link is found, and no bucket's pairs grow with the data.

Only distinct fingerprints are compared; copies meet in one row.  Groups are connected
components.  NULL and empty texts have fingerprint zero and are linked like any other;
rows without id belong to groups but never name them, unless all of a group lack it.
"""

from __future__ import annotations

from collections.abc import Iterable
from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.llm.common import free_name, join_facts
from tableward.llm.components import components
from tableward.session import stage

#: Words of a shingle, seed of its hash, largest number of differing bits.
SHINGLE, SEED, RADIUS = 3, 42, 2
#: A bucket up to this size is compared pair by pair; it is what the last level leaves at most.
SMALL, LEVELS = 64, 3
#: Shingles hashed at a time.
_BLOCK = 1 << 16


def shingle_hashes(text: str | None, size: int = SHINGLE):
    """XXH64 of every shingle, in blocks; A-Z are taken as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=-1))  # where the words end; the first entry is before the text
    n = max(len(words) - size + 1, 1)
    last = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _BLOCK):
        to = min(at + _BLOCK, n)
        yield np.fromiter((digest(joined[a + 1 : b], SEED) for a, b in zip(ends[at:to], ends[at + last : to + last])), np.uint64, to - at)


def fingerprint_of(text: str | None, size: int = SHINGLE) -> int:
    return combined(shingle_hashes(text, size))


def combined(blocks: Iterable[np.ndarray]) -> int:
    """The fingerprint of hashes, as a signed number."""
    total, n = np.zeros(64, np.int64), 0
    for hashes in blocks:
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.int64)[0]) if n else 0


@F.pandas_udf(T.LongType())
def fingerprint(text: pd.Series) -> pd.Series:
    """The fingerprint as a signed number."""
    return pd.Series([fingerprint_of(t) for t in text], dtype="int64")


def as_hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def masks(free: list[int]) -> list[tuple[int, list[int]]]:
    """For each of the seven vectors: the bits of ``free`` its mask keeps, and those it blinds."""
    found = []
    for v in range(1, 8):
        kept = [bit for k, bit in enumerate(free) if ((1 + k % 7) & v).bit_count() % 2]
        found.append((sum(1 << bit for bit in kept), [bit for bit in free if bit not in kept]))
    return found


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame) -> DataFrame:
    """``u, v``: all pairs of distinct fingerprints (column ``fp``) within the radius."""
    here = prints.select("fp", F.lit(0).alias("path"), F.lit(0).cast("long").alias("key"))
    levels = {0: (0, list(range(64)))}  # path: what is kept so far, what is free
    found = []
    for level in range(LEVELS):
        below, options = {}, []
        for path, (kept, free) in levels.items():
            parts = []
            for k, (mask, rest) in enumerate(masks(free)):
                below[path * 8 + k + 1] = (kept | mask, rest)
                mask = F.lit(_signed(kept | mask))
                parts.append(F.struct(F.lit(path * 8 + k + 1).alias("path"), F.col("fp").bitwiseAND(mask).alias("key")))
            options.append((path, F.array(*parts)))
        chosen = options[0][1] if len(options) == 1 else F.element_at(F.create_map(*[x for p, o in options for x in (F.lit(p), o)]), F.col("path"))
        here = here.select("fp", F.explode(chosen).alias("b")).select("fp", "b.path", "b.key")
        levels = below
        sizes = here.groupBy("path", "key").agg(F.count("*").alias("n")).where("n > 1")
        members = stage(here.join(sizes, ["path", "key"]), "buckets")
        last = level == LEVELS - 1
        small = members if last else members.where(F.col("n") <= SMALL)
        a, b = small.select("path", "key", F.col("fp").alias("u")), small.select("path", "key", F.col("fp").alias("v"))
        near = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS
        found.append(a.join(b, ["path", "key"]).where((F.col("u") < F.col("v")) & near).select("u", "v"))
        here = members.where(F.col("n") > SMALL).select("fp", "path", "key")
        if last or here.isEmpty():
            break
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def classes(printed: DataFrame) -> DataFrame:
    """``fp, root`` for every fingerprint that is linked to another."""
    prints = stage(printed.select("fp").distinct(), "fingerprints")
    return stage(components(links(prints)).select(F.col("node").alias("fp"), "root"), "classes")


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits), ``component_id``."""
    printed = stage(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp")), "printed")
    firsts = printed.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = stage(firsts.join(classes(printed), "fp", "left"), "rooted")
    # Only linked fingerprints have a root, so no group here holds more than what is linked.
    least = rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("first").alias("least"))
    named = rooted.join(least, "root", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    found = join_facts(printed, F.col("fp"), named, "fp", F.col("doc_id"), "named")
    return found.select("doc_id", as_hex(F.col("fp")).alias("fingerprint"), "named.component_id")


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, one per group: the smallest id, of repeated rows one."""
    row = free_name(docs, "_row")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    printed = stage(
        numbered.select(F.col(row).alias("row"), F.col(doc_id).alias("doc_id"), fingerprint(F.col(text)).alias("fp")), "printed"
    )
    found = join_facts(printed, F.col("fp"), classes(printed), "fp", F.col("row"), "class")
    grouped = stage(found.select("row", "doc_id", F.coalesce("class.root", "fp").alias("root")), "grouped")
    return only_first(numbered, row, grouped)


def only_first(numbered: DataFrame, row: str, grouped: DataFrame) -> DataFrame:
    """``numbered`` without its column ``row`` and the rows that ``grouped`` (``row, doc_id, root``) has beside a group's first."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    several = grouped.groupBy("root").agg(first, F.count("*").alias("n")).where("n > 1").select("root", "first.row")
    judged = join_facts(grouped, F.col("root"), several, "root", F.col("row"), "stays")
    dropped = judged.where(F.col("row") != F.col("stays.row")).select(F.col("row").alias(row))
    return numbered.join(dropped, row, "left_anti").drop(row)
