"""Repeated byte strings by longest-previous-factor arrays.

A byte goes when it lies in a string of ``LENGTH`` bytes that also starts earlier: in a
document with a smaller id, or further left in the same one.

To compare suffixes across a corpus, all that may be equal must meet.  Texts are sampled by
their minimizers: of every ``LENGTH`` bytes, the window of ``SEED`` bytes with the least
hash is an anchor, wherever those bytes stand.  Anchors that occur once are dropped.  Around
each occurrence of the others, the segment that holds every string with this anchor is
cut out.  Equal segments become one, that of the earliest place; the later ones are repeats as a
whole, and so are later copies of whole texts, which need not be cut at all.  Where an anchor has several different segments, their suffixes are sorted; from the
previous and next smaller positions in suffix order follows the longest factor that occurs
earlier (``previous_factors``), and starts where it reaches ``LENGTH`` are repeats.

Segments are dealt by anchor; copies have been merged before that.  An anchor with more than
``CROWD`` different segments is not sorted in one task: its segments are split and dealt again by
the anchor with the bytes left of it, and with those right of it, one of which every string holds
(``closer``).  Where even that leaves more than ``CROWD``, strings are grouped by hash instead, over
all tasks.  Nothing is capped.

Texts are UTF-8 bytes, NULL is empty.  Rows without id share one place after all others.
Rows with the same id are ordered by start only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableward.llm import rolling
from tableward.session import owner as owned
from tableward.session import release, stage, sweep

#: Bytes of a string that counts, bytes of an anchor, windows among which an anchor is the least.
LENGTH, SEED = 100, 32
WINDOWS = LENGTH - SEED + 1
#: Bytes beside an anchor, on one side or the other, that every string around it holds.
REACH = (LENGTH - SEED) // 2
#: Different segments of an anchor that are sorted in one task, and segments sorted at a time.
CROWD, BATCH = 1_000, 500
#: Bytes of short texts that are read together.
JOINED = 1 << 15
LAST = 2**63 - 1
_PLACE = "id long, mark long, start long, count long"
# For a second, independent hash.
_OTHER = rolling.mix(rolling.BYTES)


def _raw(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def _joined(texts: list[str | None]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Texts some at a time: the first one's position, their bytes one after the other, and where each begins and the last ends."""
    first, held, size = 0, [], 0
    for at, text in enumerate(texts, 1):
        held.append((text or "").encode("utf-8", "surrogatepass"))
        size += len(held[-1])
        if size > JOINED or at == len(texts):
            yield first, b"".join(held), np.cumsum([0, *map(len, held)])
            first, held, size = at, [], 0


def anchors(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, rolling.Prefix | None]:
    """Positions, texts and hashes of the anchors of joined texts, and the sums to hash their stretches with."""
    size = np.diff(bounds)
    if not (size >= LENGTH).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), None
    sums = rolling.Prefix(rolling.BYTES[raw])
    hashes = sums.windows(SEED)
    most = np.uint64(2**64 - 1)
    highest = ~rolling.sliding_minimum(hashes, WINDOWS)
    # Windows of texts that are long enough; no stretch reaches over the end of a text.
    change = np.zeros(len(raw) + 1, np.int8)
    long = size >= LENGTH
    change[bounds[:-1][long]] += 1
    change[bounds[1:][long] - SEED + 1] -= 1
    held = np.cumsum(change, dtype=np.int8)[: len(hashes)] > 0
    for end in bounds[1:-1]:
        highest[max(end - LENGTH + 1, 0) : end] = most
    # A window is an anchor if it is the least of some stretch: the largest of these minima is its own hash.
    edge = np.full(WINDOWS - 1, most)
    around = ~rolling.sliding_minimum(np.concatenate([edge, highest, edge]), WINDOWS)
    at = np.flatnonzero((around == hashes) & held)
    return at, np.searchsorted(bounds, at, "right") - 1, hashes[at].view(np.int64), sums


def listed_anchors(docs: DataFrame) -> DataFrame:
    """``anchor, times, id, mark``: the anchors of each document of ``id, mark, text``; ``times`` is 2 if one occurs more than once there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(c).to_numpy() for c in ("id", "mark"))
            for first, raw, bounds in _joined(batch.column("text").to_pylist()):
                _, owner, hashes, _ = anchors(np.frombuffer(raw, np.uint8), bounds)
                if len(owner):
                    order = np.lexsort((hashes, owner))
                    owner, hashes = owner[order] + first, hashes[order]
                    head = np.flatnonzero(np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(hashes) != 0)]))
                    n = np.diff(np.append(head, len(order)))
                    columns = hashes[head], np.minimum(n, 2).astype(np.int32), ids[owner[head]], marks[owner[head]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "times", "id", "mark"])

    return docs.mapInArrow(run, "anchor long, times int, id long, mark long")


_SEGMENT = "anchor long, digest long, id long, mark long, at long, before int, size int, bytes binary"


def stretches(starts: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or adjacent ranges below ``n`` made one: their starts and lengths."""
    change = np.zeros(n + 2, np.int64)
    np.add.at(change, starts + 1, 1)
    np.add.at(change, starts + counts + 1, -1)
    edge = np.diff((np.cumsum(change) > 0).astype(np.int8))
    first = np.flatnonzero(edge == 1)
    return first, np.flatnonzero(edge == -1) - first


def segments(docs: DataFrame) -> DataFrame:
    """The segments around the shared anchors (column ``shared``, an array) of each document.

    Of equal segments of one anchor in one document the first is given.  The others are repeats
    already: what starts in them comes as ranges, ``size`` starts from ``at``, without bytes.
    """
    names = [c.split()[0] for c in _SEGMENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = (batch.column(c).to_numpy() for c in ("id", "mark"))
            for first, joined, bounds in _joined(batch.column("text").to_pylist()):
                raw = np.frombuffer(joined, np.uint8)
                at, owner, hashes, sums = anchors(raw, bounds)
                # an anchor that is shared is so in every text
                hit = np.isin(hashes, batch.column("shared").slice(first, len(bounds) - 1).flatten().to_numpy())
                at, owner, hashes = at[hit], owner[hit], hashes[hit]
                if not len(at):
                    continue
                start, end = np.maximum(at - (LENGTH - SEED), bounds[owner]), np.minimum(at + LENGTH, bounds[owner + 1])
                digest = sums.hashes(start, end) + (at - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                digest = (digest + (end - start).astype(np.uint64)).view(np.int64)
                order = np.lexsort((at, digest, hashes, owner))
                same = (np.diff(owner[order]) == 0) & (np.diff(hashes[order]) == 0) & (np.diff(digest[order]) == 0)
                again = np.concatenate([[False], same])
                late, order = order[again], np.sort(order[~again])
                ranges, lengths = stretches(start[late], end[late] - start[late] - LENGTH + 1, len(raw))
                rest, own = np.zeros(len(ranges), np.int64), np.concatenate([owner[order], np.searchsorted(bounds, ranges, "right") - 1])
                columns = (
                    np.concatenate([hashes[order], rest]), np.concatenate([digest[order], rest]), ids[first + own], marks[first + own],
                    np.concatenate([at[order], ranges]) - bounds[own], np.concatenate([at[order] - start[order], rest]).astype(np.int32),
                    np.concatenate([end[order] - start[order], lengths]).astype(np.int32),
                )
                cut = [joined[s:e] for s, e in zip(start[order].tolist(), end[order].tolist())] + [None] * len(ranges)
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(cut, pa.binary())], names)

    return docs.mapInArrow(run, _SEGMENT)


def nearest_smaller(place: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each suffix, the prefix it has in common with the nearest suffix before it, in suffix order, whose place is smaller.

    ``common[i]`` is what suffixes ``i - 1`` and ``i`` have in common.  Candidates jump along each other's candidates.
    """
    bound = np.append(place, -1)  # the last entry, index -1, is smaller than all
    to, least = np.arange(len(place)) - 1, common.copy()
    far = np.flatnonzero(bound[to] >= place)
    while len(far):
        by = to[far]
        least[far] = np.minimum(least[far], least[by])
        to[far] = to[by]
        far = far[bound[to[far]] >= place[far]]
    return np.where(to >= 0, least, 0)


def previous_factors(suffixes: np.ndarray, place: np.ndarray) -> np.ndarray:
    """For each suffix (a row of bytes) the longest prefix that a suffix of smaller place has too."""
    n, width = suffixes.shape
    order = np.lexsort((place, np.ascontiguousarray(suffixes).view(f"S{width}").ravel()))
    lined, place = suffixes[order], place[order]
    differ = lined[1:] != lined[:-1]
    common = np.concatenate([[0], np.where(differ.any(axis=1), differ.argmax(axis=1), width)]) if n > 1 else np.zeros(n, np.int64)
    back = nearest_smaller(place, common)
    ahead = nearest_smaller(place[::-1], np.concatenate([[0], common[:0:-1]]))[::-1]
    out = np.empty(n, np.int64)
    out[order] = np.maximum(back, ahead)
    return out


def _starts(rows: list[dict]) -> tuple[np.ndarray, ...]:
    """All strings of the segments: the segments' bytes and where in them the strings are, whose they are, and where they start."""
    count = np.array([r["size"] - LENGTH + 1 for r in rows])
    owner = np.repeat(np.arange(len(rows)), count)
    joined = np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8)
    offset = np.concatenate([[0], np.cumsum([r["size"] for r in rows])])[:-1]
    within = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    first = np.array([r["at"] - r["before"] for r in rows])
    return joined, offset[owner] + within, owner, first[owner] + within


def repeated_starts(rows: list[dict]) -> pa.RecordBatch | None:
    """The starts in these segments whose previous factor is long enough, as stretches of starts."""
    joined, where, owner, start = _starts(rows)
    # a string whose hash is alone here has no factor of its whole length
    _, which, times = np.unique(rolling.Prefix(rolling.BYTES[joined]).windows(LENGTH)[where], return_inverse=True, return_counts=True)
    several = np.flatnonzero(times[which] > 1)
    if not len(several):
        return None
    ids, marks = _whose(rows, owner)
    order = np.lexsort((start[several], ids[several]))
    own, begin = ids[several][order], start[several][order]
    step = np.concatenate([[False], (own[1:] != own[:-1]) | (begin[1:] != begin[:-1])])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(step)
    strings = np.lib.stride_tricks.sliding_window_view(joined, LENGTH)[where[several]]
    return _ranges(several[previous_factors(strings, place) >= LENGTH], owner, ids, marks, start)


def _whose(rows: list[dict], owner: np.ndarray) -> tuple[np.ndarray, ...]:
    return tuple(np.array([r[k] for r in rows], np.int64)[owner] for k in ("id", "mark"))


def _ranges(found: np.ndarray, owner: np.ndarray, ids: np.ndarray, marks: np.ndarray, start: np.ndarray) -> pa.RecordBatch | None:
    """Repeated starts, by their positions among all, as ranges within each segment."""
    if not len(found):
        return None
    new = np.concatenate([[True], (np.diff(found) != 1) | (np.diff(owner[found]) != 0)])
    head = found[new]
    count = np.diff(np.append(np.flatnonzero(new), len(found)))
    return pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[head], marks[head], start[head], count)], ["id", "mark", "start", "count"])


def sorted_repeats(rows: DataFrame) -> DataFrame:
    """Repeated starts among segments, those of an anchor in one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, anchor = [], None
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= BATCH and row["anchor"] != anchor:  # an anchor's segments stay together
                    if (out := repeated_starts(held)) is not None:
                        yield out
                    held = []
                anchor = row["anchor"]
                held.append(row)
        if held and (out := repeated_starts(held)) is not None:
            yield out

    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _PLACE)


def closer(rows: DataFrame) -> DataFrame:
    """Segments split in two and dealt by longer anchors: strings with ``REACH`` bytes left of the anchor, and the others, which have as many on the right."""
    names = [c.split()[0] for c in _SEGMENT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BATCH):
                part = batch.slice(first, BATCH)
                ids, marks, at, before, size = (part.column(c).to_numpy().astype(np.int64) for c in ("id", "mark", "at", "before", "size"))
                joined, offset = b"".join(part.column("bytes").to_pylist()), np.cumsum(size) - size
                sums = rolling.Prefix(rolling.BYTES[np.frombuffer(joined, np.uint8)])
                left = np.zeros(len(size), np.int64), np.minimum(before - REACH, size - LENGTH) + LENGTH, before - REACH, before + SEED
                right = np.maximum(before - REACH + 1, 0), size, before, before + SEED + REACH
                for side, (begin, end, low, high) in enumerate((left, right)):
                    good = np.flatnonzero((end - begin >= LENGTH) & (low >= 0))
                    begin, end, low, high, base, own = (x[good] for x in (begin, end, low, high, offset, before))
                    key = sums.hashes(base + low, base + high) + np.uint64(side)
                    digest = sums.hashes(base + begin, base + end) + (own - begin).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    digest += (end - begin).astype(np.uint64)
                    columns = (
                        key.view(np.int64), digest.view(np.int64), ids[good], marks[good], at[good],
                        (own - begin).astype(np.int32), (end - begin).astype(np.int32),
                    )
                    cut = [joined[s:e] for s, e in zip((base + begin).tolist(), (base + end).tolist())]
                    yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(cut, pa.binary())], names)

    return rows.mapInArrow(run, _SEGMENT)


def hashed_repeats(rows: DataFrame) -> DataFrame:
    """The same for anchors with very many segments: equal strings meet by two hashes, and the earliest stays.

    Of equal strings among the rows at hand only the earliest goes on; the others are repeats already.
    """
    names = ["one", "two", "id", "mark", "start", "count"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH).to_pylist()
                joined, where, owner, start = _starts(part)
                ids, marks = _whose(part, owner)
                one, two = (rolling.Prefix(table[joined]).windows(LENGTH)[where].view(np.int64) for table in (rolling.BYTES, _OTHER))
                order = np.lexsort((start, ids, two, one))
                again = np.concatenate([[False], (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])])
                first = order[~again]
                columns = one[first], two[first], ids[first], marks[first], start[first], np.zeros(len(first), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)
                before = np.maximum.accumulate(np.where(again, -1, np.arange(len(order))))  # the earliest of the same
                later = (ids[order] != ids[order[before]]) | (start[order] != start[order[before]])
                if (known := _ranges(np.sort(order[again & later]), owner, ids, marks, start)) is not None:
                    nothing = pa.array(np.zeros(known.num_rows, np.int64))
                    yield pa.RecordBatch.from_arrays([nothing, nothing, *known.columns], names)

    told = stage(rows.mapInArrow(run, "one long, two long, " + _PLACE), "strings")
    strings = told.where("count = 0").drop("count")
    # a task hands on a string once for each of its parts, so that few rows meet
    first = F.min(F.struct("id", "start")).over(Window.partitionBy("one", "two"))
    later = strings.withColumn("first", first).where(F.struct("id", "start") > F.col("first"))
    return told.where("count > 0").select("id", "mark", "start", "count").unionByName(
        later.select("id", "mark", "start", F.lit(1).cast("long").alias("count"))
    )


def later_copies(docs: DataFrame) -> DataFrame:
    """``id, mark, bytes`` of the documents whose whole text an earlier document has, told by two hashes and the length."""
    told = docs.select("id", "mark", F.xxhash64(F.lit(1), "text").alias("also"), F.octet_length("text").alias("bytes"))
    told = stage(told.where(F.col("bytes") >= LENGTH), "texts")
    first = told.groupBy("mark", "also", "bytes").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    return told.join(first.drop("last"), ["mark", "also", "bytes"]).where("id > first").select("id", "mark", "bytes").distinct()


def shared_anchors(docs: DataFrame, whole: DataFrame) -> DataFrame:
    """``id, mark, shared``: the anchors of each document that occur elsewhere too; not of those in ``whole``."""
    sampled = stage(listed_anchors(docs), "anchors")
    # Copies of one text count once here.
    spread = sampled.groupBy("anchor").agg(F.min("mark").alias("one"), F.max("mark").alias("other"), F.max("times").alias("times"))
    shared = spread.where("one <> other OR times > 1").select("anchor")
    wanted = sampled.join(shared, "anchor").groupBy("id", "mark").agg(F.collect_list("anchor").alias("shared"))
    return stage(wanted.join(whole, ["id", "mark"], "left_anti"), "shared")


def distinct_segments(given: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first of equal segments, of anchors with several different ones, and their number ``n``; and the starts in the later ones."""
    firsts = given.groupBy("anchor", "digest").agg(F.min(F.struct("id", "at", "mark")).alias("first"))
    firsts = stage(firsts.select("anchor", "digest", "first.*"), "firsts")
    sweep(given.sparkSession)
    earlier = firsts.select("anchor", "digest", F.struct("id", "at").alias("first"))
    later = given.drop("bytes").join(earlier, ["anchor", "digest"]).where(F.struct("id", "at") > F.col("first"))
    later = later.select("id", "mark", (F.col("at") - F.col("before")).alias("start"), (F.col("size") - LENGTH + 1).cast("long").alias("count"))
    several = firsts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    return given.join(firsts.join(several, "anchor"), ["anchor", "digest", "id", "mark", "at"]), later


def repeats(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``id, mark, start, count``: where repeated strings start in the documents of ``id, mark, text``.

    Tables of a phase are deleted as soon as the next one is written.
    """
    spark = docs.sparkSession
    whole = stage(later_copies(docs), "copies")
    with owned(f"anchors-{uuid.uuid4().hex}") as listed:
        wanted = shared_anchors(docs, whole)
    sweep(spark)
    with owned(f"segments-{uuid.uuid4().hex}") as cuts:
        cut = stage(segments(docs.join(wanted, ["id", "mark"])), "segments")
        release(spark, listed)
        sweep(spark)
        inside = cut.where("bytes IS NULL").select("id", "mark", F.col("at").alias("start"), F.col("size").cast("long").alias("count"))
        compared, later = distinct_segments(cut.where("bytes IS NOT NULL"))
    known = stage(later.unionByName(inside), "known")
    sweep(spark)
    compared = stage(compared, "compared")
    release(spark, cuts)
    sweep(spark)
    copies = whole.select("id", "mark", F.lit(0).cast("long").alias("start"), (F.col("bytes") - LENGTH + 1).cast("long").alias("count"))
    found = sorted_repeats(compared.where(F.col("n") <= crowd)).unionByName(known).unionByName(copies)
    many = compared.where(F.col("n") > crowd)
    if not many.isEmpty():
        split, later = distinct_segments(stage(closer(many), "closer"))
        split = stage(split, "split")
        sweep(spark)
        found = found.unionByName(later).unionByName(sorted_repeats(split.where(F.col("n") <= crowd)))
        found = found.unionByName(hashed_repeats(split.where(F.col("n") > crowd)))
    return found


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans``, ``kept`` (the bytes left)."""
    spark = docs.sparkSession
    slim = docs.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST)).alias("id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("mark"), F.col(text).alias("text"),
    )
    found = repeats(slim.select("id", "mark", "text"))
    gone = stage(found.groupBy("id", "mark").agg(F.collect_list(F.struct("start", "count")).alias("gone")), "repeats")
    sweep(spark)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, spans, kept = [], [], [], []
            for text, gone in zip(batch.column("text").to_pylist(), batch.column("gone")):
                raw = _raw(text)
                change = np.zeros(len(raw) + 1, np.int64)
                if gone.is_valid:
                    start = gone.values.field("start").to_numpy()
                    np.add.at(change, start, 1)
                    np.add.at(change, start + gone.values.field("count").to_numpy() + LENGTH - 1, -1)
                covered = np.cumsum(change)[:-1] > 0
                size.append(len(raw))
                removed.append(int(covered.sum()))
                spans.append(int((np.diff(covered.astype(np.int8), prepend=0) == 1).sum()))
                kept.append(raw[~covered].tobytes())
            columns = [pa.array(c, pa.int64()) for c in (size, removed, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
            )

    joined = slim.join(gone, ["id", "mark"], "left").select("doc_id", "text", "gone")
    kind = docs.schema[doc_id].dataType.simpleString()
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
