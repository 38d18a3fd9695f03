"""Near copies by SimHash fingerprints and covering masks, confirmed and completed by exact Jaccard similarity.

Two texts are linked when the Jaccard similarity of their sets of five-word shingles is
at least ``ALIKE`` of 4/5.  Operator 8's fingerprints of five-word shingles and its covering
masks (``simhash.links``) link the texts; similar texts may differ in more bits than any
mask covers, so a prefix-filtered set join finds what is left.  The steps:

1. One pass takes the fingerprint of every text and deals out of its set the shingles of
   smallest hash, 3/10 of them.  All fingerprints of the table go through the masks.
   Similar sets have at least a tenth of the smaller one in common among what is dealt, so a
   text of which fewer than 8 in 100 of its shingles meet another text's there has no near
   copy, and its links are refuted.
2. The sets of the others are counted in whole.  A set of which fewer than 4 of 5 shingles
   are in another one goes, as it has none either.  The rest is put in order, the rarest
   shingle first.
3. Texts of the same fingerprint, and of fingerprints within ``simhash.RADIUS`` bits, are
   proposed as pairs: first each text with the first of its fingerprint, and each fingerprint's
   first with that of the nearest of the smaller ones linked to it; then the first texts of
   every link that don't hang together yet, if their parities (step 4) allow it.  Then each text proposes one more partner:
   of the buckets of its leading shingles the middle one it meets most often, the middle
   being the text with the smallest share of rarer shingles, that is with the fewest edits.
   Two rounds of this hang most near copies of one text together, however many they are,
   by one pair per text.
4. A set of n can only reach the similarity with another when they share one of their
   first n/5 + 1 shingles, and the smaller one of its first n/9 + 1; and their first common
   shingle, at places p and q, leaves min(n - p, m - q) of overlap at most.  So the buckets
   of leading shingles hold every pair, those of one fingerprint too; those whose texts don't
   hang together yet are compared.  Each set has ``MARKS`` parities, of its shingles by hash: two sets differ in
   as many shingles as parities at least, so a pair with too many different ones is left out,
   and no similar pair is.

Pairs are confirmed by the sets' overlap; texts don't move.  Groups are connected
components, found on what each step adds between groups.  Equal sets count as one from
step 2 on.  NULL and empty texts have the empty text as their one shingle, a text of under
five words has all of its words.  Shingles are told apart by 64-bit hashes.  Repeated rows
are equal sets; ids may be NULL or repeat; other columns pass through; of an empty table
nothing is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableward.llm import bitmaps, simhash
from tableward.llm.common import free_name, join_facts
from tableward.llm.components import components
from tableward.llm.simhash import only_first, shingle_hashes
from tableward.session import stage

#: Words of a shingle; the least similarity as a fraction.
SHINGLE, ALIKE = 5, (4, 5)
#: Of a set, the share beyond its leading shingles that is dealt out in step 1, one of so many.
EXTRA = 10
#: Rounds of proposals.
ROUNDS = 2
#: Parities of a set, a multiple of 64, and their columns.
MARKS = 256
_MARKS = [f"x{i}" for i in range(MARKS // 64)]
#: Postings handed on at a time.
_BLOCK = 1 << 18


def _distinct(blocks: list[np.ndarray]) -> np.ndarray:
    """The hashes of a text's shingles, ascending, each once."""
    return np.unique(np.concatenate(blocks)) if blocks else np.zeros(1, np.uint64)


def parities(tokens: np.ndarray) -> np.ndarray:
    """For each remainder by ``MARKS`` whether an odd number of the set's hashes has it, as signed numbers."""
    return np.packbits(np.bincount(tokens.view(np.uint64) % MARKS, minlength=MARKS) % 2 == 1, bitorder="little").view(np.int64)


def _up(n: int, of: int) -> int:
    """n * ALIKE / of, rounded up."""
    return -(-ALIKE[0] * n // (ALIKE[1] * of))


def postings(texts: DataFrame) -> DataFrame:
    """``token, row, n``: of each set the shingles of smallest hash, those of step 1, and its size; with n = 0 the text's fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text")):
                blocks = list(shingle_hashes(text.as_py(), SHINGLE))
                tokens = _distinct(blocks)
                n = len(tokens)
                some = tokens[: n - _up(n, 1) + -(-n // EXTRA)]
                held += [(np.array([simhash.combined(blocks)]), row, 0), (some.view(np.int64), row, n)]
                size += len(some) + 1
                if size >= _BLOCK:
                    yield _postings(held)
                    held, size = [], 0
            if held:
                yield _postings(held)

    return texts.mapInArrow(run, "token long, row long, n int")


def _postings(held: list[tuple[np.ndarray, int, int]]) -> pa.RecordBatch:
    sizes = [len(t) for t, *_ in held]
    rows, counts = np.array([r for _, r, _ in held], np.int64), np.array([n for *_, n in held], np.int32)
    columns = [np.concatenate([t for t, *_ in held]), np.repeat(rows, sizes), np.repeat(counts, sizes)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "row", "n"])


def _repeated(tokens: DataFrame) -> DataFrame:
    """``token, df`` of the shingles of several rows."""
    return tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")


def links(dealt: DataFrame) -> DataFrame:
    """Step 1: ``u, v``: all pairs of distinct fingerprints, of all texts, that the covering masks link."""
    prints = stage(dealt.where("n = 0").select(F.col("token").alias("fp")).distinct(), "prints")
    return stage(simhash.links(prints), "links")


def met(dealt: DataFrame) -> DataFrame:
    """Step 1: the rows that may have a near copy."""
    dealt = dealt.where("n > 0")
    common = dealt.join(_repeated(dealt), "token").groupBy("row", "n").agg(F.count("*").alias("m"))
    a, b = ALIKE
    return common.where(f"m * {b * EXTRA} >= {a} * CAST(n AS BIGINT)").select("row")


def sets(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """``row, n, tokens, fp`` and the parities: the whole sets of some rows, and the texts' fingerprints."""
    listed = stage(rows, "rows")
    known = texts.sparkSession.sparkContext.broadcast(bitmaps.collect(listed.select(F.xxhash64("row")), listed.count()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted = np.flatnonzero(known.value.holds(batch.column("hash").to_numpy().view(np.uint64)))
            if len(wanted):
                text = batch.column("text")
                hashed = [list(shingle_hashes(text[int(i)].as_py(), SHINGLE)) for i in wanted]
                found = [_distinct(blocks) for blocks in hashed]
                prints = pa.array(np.array([simhash.combined(blocks) for blocks in hashed], np.int64))
                marks = np.stack([parities(t) for t in found])
                offsets = np.concatenate([[0], np.cumsum([len(t) for t in found])]).astype(np.int32)
                tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).view(np.int64)))
                row = pa.array(batch.column("row").to_numpy()[wanted])
                columns = [row, pa.array(np.diff(offsets)), tokens, prints, *[pa.array(np.ascontiguousarray(m)) for m in marks.T]]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "n", "tokens", "fp", *_MARKS])

    keyed = texts.select("row", "text", F.xxhash64("row").alias("hash"))
    schema = ", ".join(["row long, n int, tokens array<long>, fp long", *[f"{m} long" for m in _MARKS]])
    return keyed.mapInArrow(run, schema).join(listed, "row", "left_semi")


def ordered(kept: DataFrame) -> DataFrame:
    """Step 2: of the sets that are mostly in others ``row, n, tokens``, the shingles they share, the rarest first, and the rest of ``kept``."""
    tokens = kept.select("row", "n", F.explode("tokens").alias("token"))
    counted = tokens.join(_repeated(tokens.select("token")), "token")
    found = counted.groupBy("row", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))  # of one text
    a, b = ALIKE
    mostly = found.where(f"size(t) * {b} >= {a} * CAST(n AS BIGINT)").select("row", "n", F.col("t.token").alias("tokens"))
    return mostly.join(kept.drop("n", "tokens"), "row")


#: Whether a pair of n and m shingles, first met at the places p and q, can reach the similarity.
_CAN = "least(n - p, m - q) * CAST({0} + {1} AS BIGINT) >= {0} * (CAST(n AS BIGINT) + m)".format(*ALIKE)
#: Whether such a pair has as few different parities as it may have different shingles.
_MARKED = "({2}) * ({0} + {1}) <= ({1} - {0}) * (CAST(n AS BIGINT) + m)".format(*ALIKE, " + ".join(f"bit_count({x} ^ {x}_)" for x in _MARKS))
#: Whether the smaller set of such a pair can have its first common shingle at p.
_SMALLER = "(n - p) * CAST({0} + {1} AS BIGINT) >= 2 * {0} * CAST(n AS BIGINT)".format(*ALIKE)


def leading(found: DataFrame) -> DataFrame:
    """``token, row, n, p`` and the parities: the leading shingles of sets in order, and their places; shingles of no other set come first."""
    alone = F.col("n") - F.size("tokens")
    a, b = ALIKE
    lead = F.expr(f"CAST(n - ({a} * CAST(n AS BIGINT) + {b - 1}) DIV {b} + 1 AS INT)")
    some = F.slice("tokens", F.lit(1), F.greatest(lead - alone, F.lit(0)))
    return found.select("row", "n", *_MARKS, alone.alias("alone"), F.posexplode(some).alias("at", "token")).select(
        "token", "row", "n", (F.col("alone") + F.col("at")).alias("p"), *_MARKS
    )


def printed(kept: DataFrame, same: DataFrame, found: DataFrame) -> DataFrame:
    """``row, fp``: the fingerprints of the rows of ``found``, and of those whose sets equal theirs."""
    named = kept.select("row", "fp").join(same, "row").select(F.col("root").alias("row"), "fp").distinct()
    return named.join(found.select("row"), "row", "left_semi")


def linked(prints: DataFrame, near: DataFrame | None = None) -> DataFrame:
    """Step 3: ``u, v``: each row with the first of its fingerprint, and the first row of each fingerprint with that of the nearest it is linked to.

    ``near`` has the links of fingerprints; if it is not given, they are made of those of ``prints``.
    """
    firsts = stage(prints.groupBy("fp").agg(F.min("row").alias("first")), "firsts")
    same = join_facts(prints.select("row", "fp"), F.col("fp"), firsts, "fp", F.col("row"), "at")
    same = same.where(F.col("row") > F.col("at.first")).select(F.col("at.first").alias("u"), F.col("row").alias("v"))
    ends = firsts.select(F.col("fp").alias("u"), F.col("first").alias("a")), firsts.select(F.col("fp").alias("v"), F.col("first").alias("b"))
    both = (simhash.links(firsts) if near is None else near).join(ends[0], "u").join(ends[1], "v").where("a <> b")
    nearest = both.groupBy("v", "b").agg(F.min_by("a", F.struct(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))), "u")).alias("a"))
    return same.unionByName(nearest.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))).distinct()


def apart(prints: DataFrame, near: DataFrame, rooted: DataFrame) -> DataFrame:
    """Step 3: ``u, v``: the first rows of each link's fingerprints, where they are of different groups and can be alike."""
    facts = ["row", "root", "n", *_MARKS]
    firsts = prints.join(rooted, "row").groupBy("fp").agg(F.min(F.struct(*facts)).alias("first"))
    firsts = stage(firsts.select("fp", *[f"first.{f}" for f in facts]), "firsts")
    named = ["b", "other", "m", *[f"{x}_" for x in _MARKS]]
    other = firsts.select(F.col("fp").alias("v"), *[F.col(f).alias(name) for f, name in zip(facts, named)])
    ends = near.join(firsts.withColumnsRenamed({"fp": "u", "row": "a"}), "u").join(other, "v").where("root <> other")
    return ends.where(_MARKED).select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct()


def proposals(rows: DataFrame) -> DataFrame:
    """Step 3: ``u, v``: for each row the middle of another group that it meets most often in its buckets."""
    middle = F.min(F.struct((F.col("p") / F.col("n")).alias("part"), "row", "root", "n", "p")).alias("first")
    firsts = rows.groupBy("token").agg(middle, F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    meets = rows.join(firsts, "token").where(F.col("root") != F.col("first.root")).select(
        F.col("row").alias("v"), "n", "p", F.col("first.row").alias("u"), F.col("first.n").alias("m"), F.col("first.p").alias("q")
    )
    often = meets.where(_CAN).groupBy("v", "u").agg(F.count("*").alias("c"))
    return often.groupBy("v").agg(F.max_by("u", F.struct("c", -F.col("u"))).alias("u")).select("u", "v")


def pairs(rows: DataFrame) -> DataFrame:
    """Step 4: ``u, v``: all pairs of different groups that can reach the similarity."""
    mixed = rows.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("token")
    left = stage(rows.join(mixed, "token"), "mixed")
    other = left.select(
        "token", F.col("row").alias("v"), F.col("n").alias("m"), F.col("p").alias("q"), F.col("root").alias("other"), *[F.col(x).alias(f"{x}_") for x in _MARKS]
    )
    smaller = left.where(_SMALLER).withColumnRenamed("row", "u")
    larger = F.struct("n", "u") < F.struct("m", "v")
    met_once = smaller.join(other, "token").where(larger & (F.col("root") != F.col("other"))).where(_CAN).where(_MARKED)
    return met_once.select("u", "v").distinct()


def confirmed(candidates: DataFrame, found: DataFrame) -> DataFrame:
    """Those pairs whose sets reach the similarity."""
    both = candidates.join(found.select(F.col("row").alias("u"), "n", F.col("tokens").alias("s")), "u")
    both = both.join(found.select(F.col("row").alias("v"), F.col("n").alias("m"), F.col("tokens").alias("t")), "v")
    shared = both.select("u", "v", "n", "m", F.size(F.array_intersect("s", "t")).cast("long").alias("both"))
    a, b = ALIKE
    return shared.where(f"both * {b} >= {a} * (CAST(n AS BIGINT) + m - both)").select("u", "v")


def _joined(groups: DataFrame, edges: DataFrame) -> DataFrame:
    """``row, root`` of the rows of ``groups`` after ``edges`` have joined some of them; a group's root is its smallest row."""
    roots = groups.select(F.col("row").alias("u"), F.col("root").alias("a")), groups.select(F.col("row").alias("v"), F.col("root").alias("b"))
    between = stage(edges.join(roots[0], "u").join(roots[1], "v").select(F.col("a").alias("u"), F.col("b").alias("v")), "between")
    moved = components(between).select(F.col("node").alias("root"), F.col("root").alias("to"))
    return stage(groups.join(moved, "root", "left").select("row", F.coalesce("to", "root").alias("root")), "groups")


def classes(texts: DataFrame) -> DataFrame:
    """``row, root`` for every row of ``texts`` (``row, text``) that may be linked to another; alone, its root is itself."""
    dealt = stage(postings(texts), "postings")
    near = links(dealt)
    kept = stage(sets(texts, met(dealt)), "sets")
    # equal sets are told by all their hashes; one row stands for them
    named = kept.select("row", F.sha2(F.array_join(F.col("tokens").cast("array<string>"), " "), 256).alias("name"))
    equal = named.groupBy("name").agg(F.min("row").alias("root"))
    same = stage(named.join(equal, "name").select("row", "root"), "equal")
    found = stage(ordered(kept.drop("fp").join(same.where("row = root").select("row"), "row", "left_semi")), "ordered")
    prints = stage(printed(kept, same, found), "printed")
    rows = stage(leading(found), "leading")
    groups = stage(found.select("row", F.col("row").alias("root")), "groups")
    by_prints = [lambda: linked(prints, near), lambda: apart(prints, near, found.drop("tokens").join(groups, "row"))]
    by_buckets = [*[lambda: proposals(rows.join(groups, "row"))] * ROUNDS, lambda: pairs(rows.join(groups, "row"))]
    for candidates in by_prints + by_buckets:
        edges = stage(confirmed(candidates(), found), "alike")
        if not edges.isEmpty():
            groups = _joined(groups, edges)
    moved = groups.select(F.col("row").alias("root"), F.col("root").alias("to"))
    return same.join(moved, "root", "left").select("row", F.coalesce("to", "root").alias("root"))


def representatives(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, one per group: the smallest id, of repeated rows one."""
    row = free_name(docs, "_row")
    numbered = stage(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = stage(classes(numbered.select(F.col(row).alias("row"), F.col(text).alias("text"))), "classes")
    ids = numbered.select(F.col(row).alias("row"), F.col(doc_id).alias("doc_id"))
    return only_first(numbered, row, stage(ids.join(found, "row"), "grouped"))
