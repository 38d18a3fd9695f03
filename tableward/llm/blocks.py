"""Repeated passages by fixed-block anchors.

Every document's words are cut into non-overlapping blocks of ``BLOCK`` words, whose hashes
are the index.  Every rolling window of ``BLOCK`` words of every document probes it.  A run
of ``RUN`` words always holds a whole block, so of two documents that share one, the
earlier's block is hit by the later.  Hits are then extended: around them, both documents
name the hashes of their runs of ``RUN`` words, and a run counts as repeated where a
smaller ``doc_id`` names it too.  Neighbouring runs make up the maximal repeats.

Probes are many and small, so they travel packed: a row holds the hashes that many
documents send to one bucket, as binary.  A bucket first reads its part of the index (one entry per
hash, that of the smallest document), then streams the probes past it, so its memory
does not grow with how often a block occurs; a bucket's probes are dealt over ``SALTS``
tasks.  Documents are never paired.

NULL text has no words.  Rows without ``doc_id`` come after all others and never remove
each other; neither do rows with the same id.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableward.llm import rolling
from tableward.session import stage, sweep

#: Words of a block and of a run that counts; tasks over which the probes of a bucket are dealt.
BLOCK, RUN, SALTS = 25, 50, 4
#: Windows packed into one set of rows.
_PACKED = 1 << 19
#: Stands for a missing id: after all others.
LAST = 2**63 - 1
_PACK = "bucket int, salt int, probe int, ids binary, counts binary, rests binary"


def words_of(text: str | None) -> np.ndarray:
    return rolling.word_hashes(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8))


def dealt(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32 further bits of each hash."""
    return (hashes >> np.uint64(32)) % np.uint64(buckets), hashes.astype(np.uint32)


def _packed(ids: list[int], hashes: list[np.ndarray], buckets: int, probe: int, salts: list[int]) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket and salt each: the documents' ids, how many hashes of each, the hashes."""
    bucket, rest = dealt(np.concatenate(hashes), buckets)
    owner = np.repeat(np.arange(len(ids)), [len(h) for h in hashes])
    order = np.argsort(bucket.astype(np.int32), kind="stable")
    bucket, rest, owner = bucket[order], rest[order], owner[order]
    edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    all_ids, rows = np.array(ids, np.int64), []
    for s, e in zip(edge, np.append(edge[1:], len(bucket))):
        first = np.flatnonzero(np.concatenate([[True], owner[s + 1 : e] != owner[s : e - 1]]))
        counts = np.diff(np.append(first, e - s)).astype(np.uint32)
        for salt in salts:
            rows.append((int(bucket[s]), salt, probe, all_ids[owner[s:e][first]].tobytes(), counts.tobytes(), rest[s:e].tobytes()))
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
            ["bucket", "salt", "probe", "ids", "counts", "rests"],
        )


def anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """The index (``probe`` 0) and the probes (``probe`` 1) of ``docs`` (``id, text``), packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, blocks, windows, size = [], [], [], 0

        def out() -> Iterator[pa.RecordBatch]:
            yield from _packed(ids, blocks, buckets, 0, list(range(SALTS)))
            yield from _packed(ids, windows, buckets, 1, [ids[0] % SALTS])

        for batch in batches:
            for own, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text)
                if len(words) < RUN:
                    continue
                rolled = rolling.Prefix(words).windows(BLOCK)
                ids.append(own)
                blocks.append(np.unique(rolled[::BLOCK]))
                windows.append(np.unique(rolled))
                size += len(rolled)
                if size >= _PACKED:
                    yield from out()
                    ids, blocks, windows, size = [], [], [], 0
        if ids:
            yield from out()

    return docs.mapInArrow(run, _PACK)


class Bucket:
    """The index of one bucket, and who has been hit."""

    def __init__(self, key: tuple[int, int]):
        self.key, self.parts, self.rests = key, [], None

    def index(self, ids: np.ndarray, rests: np.ndarray) -> None:
        self.parts.append((rests, ids))
        if len(self.parts) > 64:
            self.settle()

    def settle(self) -> None:
        """One entry per hash, that of the smallest id."""
        if not self.parts:
            return
        rests, ids = (np.concatenate(c) for c in zip(*self.parts))
        order = np.lexsort((ids, rests))
        rests, ids = rests[order], ids[order]
        first = np.concatenate([[True], rests[1:] != rests[:-1]])
        self.parts = [(rests[first], ids[first])]

    def probe(self, ids: np.ndarray, rests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those probes that hit a block of a smaller document."""
        if self.rests is None:
            self.settle()
            self.rests, self.ids = self.parts[0] if self.parts else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
            self.hit = np.zeros(len(self.rests), bool)
        if not len(self.rests):
            return ids[:0], rests[:0]
        at = np.minimum(np.searchsorted(self.rests, rests), len(self.rests) - 1)
        found = (self.rests[at] == rests) & (self.ids[at] < ids)
        self.hit[at[found]] = True
        return ids[found], rests[found]

    def owners(self) -> tuple[np.ndarray, np.ndarray]:
        """The blocks that were hit, with the smallest document that has them."""
        return (self.ids[self.hit], self.rests[self.hit]) if self.rests is not None else (np.zeros(0, np.int64), np.zeros(0, np.uint32))


def hits(packed: DataFrame, parts: int) -> DataFrame:
    """``id, bucket, rests``: for each document the hashes it shares with a smaller one, or lends to a larger one."""

    def rows(key: tuple[int, int], ids: np.ndarray, rests: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(ids):
            order = np.argsort(ids, kind="stable")
            ids, rests = ids[order], rests[order]
            first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            lists = [rests[s:e].tobytes() for s, e in zip(first, np.append(first[1:], len(ids)))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[first], pa.int64()), pa.array([key[0]] * len(first), pa.int32()), pa.array(lists, pa.binary())], ["id", "bucket", "rests"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Bucket | None = None
        for batch in batches:
            for bucket, salt, probe, ids, counts, rests in zip(*(batch.column(c).to_pylist() for c in ("bucket", "salt", "probe", "ids", "counts", "rests"))):
                if now is None or now.key != (bucket, salt):
                    if now is not None:
                        yield from rows(now.key, *now.owners())
                    now = Bucket((bucket, salt))
                owners = np.repeat(np.frombuffer(ids, np.int64), np.frombuffer(counts, np.uint32))
                hashes = np.frombuffer(rests, np.uint32)
                if probe:
                    yield from rows(now.key, *now.probe(owners, hashes))
                else:
                    now.index(owners, hashes)
        if now is not None:
            yield from rows(now.key, *now.owners())

    ordered = packed.repartition(parts, "bucket", "salt").sortWithinPartitions("bucket", "salt", "probe")
    return ordered.mapInArrow(run, "id long, bucket int, rests binary")


def run_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes, 96 bits together, of each run of ``RUN`` words."""
    return (
        rolling.Prefix(words).windows(RUN).view(np.int64),
        rolling.Prefix(rolling.mix(words ^ np.uint64(0x5BD1E995A5A5A5A5))).windows(RUN).astype(np.uint32).view(np.int32),
    )


def near_hits(words: np.ndarray, hit: np.ndarray, buckets: int) -> np.ndarray:
    """The starts of runs that hold a window among ``hit``, buckets and rests joined to one number."""
    if len(words) < RUN or not len(hit):
        return np.zeros(0, np.int64)
    bucket, rest = dealt(rolling.Prefix(words).windows(BLOCK), buckets)
    seen = np.concatenate([[0], np.cumsum(np.isin((bucket << np.uint64(32)) | rest.astype(np.uint64), hit))])
    starts = np.arange(len(words) - RUN + 1)
    return starts[seen[starts + RUN - BLOCK + 1] > seen[starts]]


def runs(docs: DataFrame, hit: DataFrame, buckets: int) -> DataFrame:
    """``id, high, low``: the runs of ``RUN`` words around the hits, each once per document."""
    grouped = hit.groupBy("id").agg(F.collect_list(F.struct("bucket", "rests")).alias("hit"))

    def numbers(some: pa.StructArray) -> np.ndarray:
        listed = zip(some.field("bucket").to_pylist(), some.field("rests").to_pylist())
        return np.concatenate([(np.uint64(b) << np.uint64(32)) | np.frombuffer(r, np.uint32).astype(np.uint64) for b, r in listed])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, text, some in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), batch.column("hit")):
                words = words_of(text)
                starts = near_hits(words, np.unique(numbers(some.values)), buckets)
                if len(starts):
                    keys = np.unique(np.stack([k[starts].astype(np.int64) for k in run_keys(words)]), axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(keys.shape[1], own)), pa.array(keys[0]), pa.array(keys[1].astype(np.int32))], ["id", "high", "low"]
                    )

    return docs.join(grouped, "id").mapInArrow(run, "id long, high long, low int")




def covered(words: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Which words lie in a run whose hash halves are among ``high`` and ``low``."""
    marks = np.zeros(len(words) + 1, np.int64)
    if len(high) and len(words) >= RUN:
        own = run_keys(words)
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        at = np.searchsorted(high, own[0])
        for _ in range(int(np.unique(high, return_counts=True)[1].max())):  # equal first halves lie side by side
            inside = np.minimum(at, len(high) - 1)
            found = np.flatnonzero((high[inside] == own[0]) & (low[inside] == own[1]))
            marks[found] += 1
            marks[found + RUN] -= 1
            at = at + 1
    return np.cumsum(marks)[:-1] > 0


def repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, id, text, keys``: every row with the runs it shares with a smaller ``doc_id``."""
    spark = docs.sparkSession
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 8)
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.col(text).alias("text"))
    hit = stage(hits(anchors(slim.select("id", "text"), buckets), buckets), "hits")
    sweep(spark)  # the probes are the largest part of what is shuffled, and are done with
    named = stage(runs(slim.select("id", "text"), hit, buckets), "runs")
    sweep(spark)
    first = named.groupBy("high", "low").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    later = named.join(first, ["high", "low"]).where("first < id")
    keys = stage(later.groupBy("id").agg(F.collect_list(F.struct("high", "low")).alias("keys")), "repeats")
    sweep(spark)
    return slim.join(keys, "id", "left")


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed``, ``kept`` (the words left, joined by blanks)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, kept = [], [], []
            for text, keys in zip(batch.column("text").to_pylist(), batch.column("keys")):
                listed = (text or "").encode("utf-8", "surrogatepass").split()
                gone = np.zeros(len(listed), bool)
                if keys.is_valid:
                    gone = covered(words_of(text), keys.values.field("high").to_numpy(), keys.values.field("low").to_numpy())
                size.append(len(listed))
                removed.append(int(gone.sum()))
                kept.append(b" ".join(w for w, g in zip(listed, gone) if not g) if gone.any() else b" ".join(listed))
            columns = [pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_removed", "kept"])

    found = repeats(docs, text, doc_id).select("doc_id", "text", "keys")
    return found.mapInArrow(cut, f"doc_id {docs.schema[doc_id].dataType.simpleString()}, n_words long, n_removed long, kept string")
