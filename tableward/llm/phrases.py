"""Phrase collocations: phrases whose words come together far more often than their parts come apart.

Phrases are counted by length, one pass over the texts each.  A task numbers the words it
meets and counts runs of them in a trie per language.  The trie is laid out by depth: the
nodes of a depth are one sorted array of numbers, each packed from its parent's number and
a word, so that a phrase takes some 16 bytes.  New phrases wait in a container that bursts
into the trie when it has grown large.  When a task holds too many phrases it spills its
largest subtrees whole; Spark deals the phrases out by their prefix and adds up what meets there.

A phrase can only be frequent when both phrases that are a word shorter are.  The frequent
phrases of one pass become a bitmap of hashes, of bounded size, and the next pass counts
just the phrases whose parts are in it.  A collision costs a count too many of rare
phrases, never a wrong number: phrases are told apart by their words.

Texts are lower-cased in A-Z only; NULL text has no words; languages that are NULL are
``UNKNOWN``, together with a language of that name.  Phrases don't reach over the end of a
piece or of a text.  Texts of any length are read in parts that overlap by a phrase less a
word.  Repeated rows and texts count as often as they come; ties go by count, then by the
phrase.  An empty table, or a language without frequent phrases, has no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableward.llm import bitmaps
from tableward.llm.bitmaps import Bitmap
from tableward.llm.rolling import mix
from tableward.session import stage

#: Most words of a phrase, its least count, phrases reported per language, the score's scale, and the percentage that lets a longer phrase stand for it.
WORDS, LEAST, TOP, SCALE, COVERED = 4, 30, 2000, 2_000_000, 80
UNKNOWN = "und"
#: Shares of a language's phrases that are ranked by themselves first.
SHARES = 64
#: Phrases of a container until it bursts; phrases a task holds; words it numbers, and their bytes; bytes read at a time; rows handed on.
BURST, ENTRIES, NUMBERED, HELD, BLOCK, ROWS = 1 << 18, 2_000_000, 1 << 20, 1 << 26, 1 << 20, 1 << 14
#: Texts taken from a batch at a time.
TEXTS = 1_000
_END = b"\xff"  # no byte of a text
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_CUT = bytes.maketrans(_UPPER + b".,;:!?\n\x0b\x0c\r\t", _UPPER.lower() + _END * 10 + b" ")
_BREAK = re.compile(b"[ \xff]")
_ID = 21
_WORD = (1 << _ID) - 1


def _tokens(raw: bytes) -> pa.DictionaryArray:
    """The words of a block's bytes, and ``_END`` where a piece ends."""
    letters = np.frombuffer(raw, np.uint8)
    letters = letters[(inside := letters != ord(" "))]
    end = letters == _END[0]
    start = end.copy()
    start[1:] |= end[:-1]
    start |= np.concatenate([[True], ~inside])[:-1][inside]
    offsets = np.append(np.flatnonzero(start), len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words.dictionary_encode()


def _blocks(texts: list[str | None]) -> Iterator[tuple[bytes, bool]]:
    """The texts' bytes some at a time, ready to be split, cut between words; and whether a block goes on in the text of the one before."""
    held, size = [], 0
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass").translate(_CUT)
        if len(raw) > BLOCK:
            at = 0
            while at < len(raw):
                to = found.start() if (found := _BREAK.search(raw, at + BLOCK)) else len(raw)
                yield raw[at:to], at > 0
                at = to
        else:
            held.append(raw)
            size += len(raw)
            if size > BLOCK:
                yield _END.join(held), False
                held, size = [], 0
    if held:
        yield _END.join(held), False


def _extended(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hashes of phrases with one more word."""
    return mix(hashes * np.uint64(0x9E3779B97F4A7C15) + word)


def _word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word)


def _seed(lang: str) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 1)], np.uint64)


class _Level:
    """The nodes of one depth, their parents' numbers and a word packed, in order; and each one's number or count."""

    def __init__(self):
        self.keys, self.values, self.next, self.order = np.zeros(0, np.int64), np.zeros(0, np.int64), 0, None

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where keys are or would be, and which are there."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return at, known

    def _insert(self, at: np.ndarray, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys, self.values, self.order = np.insert(self.keys, at, keys), np.insert(self.values, at, values), None

    def count(self, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        at, known = self._find(keys)
        self.values[at[known]] += counts[known]
        self._insert(at[~known], keys[~known], counts[~known])

    def number(self, keys: np.ndarray) -> np.ndarray:
        """The numbers of nodes; new nodes get the next ones."""
        keys, back = np.unique(keys, return_inverse=True)
        at, known = self._find(keys)
        out = np.empty(len(keys), np.int64)
        out[known] = self.values[at[known]]
        new = len(keys) - int(known.sum())
        out[~known] = np.arange(self.next, self.next + new)
        self.next += new
        self._insert(at[~known], keys[~known], out[~known])
        return out[back]

    def keys_of(self, numbers: np.ndarray) -> np.ndarray:
        if self.order is None:
            self.order = np.argsort(self.values)
        return self.keys[self.order[np.searchsorted(self.values, numbers, sorter=self.order)]]

    def keep(self, left: np.ndarray) -> None:
        self.keys, self.values, self.order = self.keys[left], self.values[left], None


class Trie:
    """Counts of phrases of ``words`` words: a level for each depth from the second, the last with the counts."""

    def __init__(self, words: int):
        self.words, self.levels = words, [_Level() for _ in range(max(words - 1, 1))]
        self.waiting, self.container = 0, []

    @property
    def entries(self) -> int:
        return len(self.levels[-1].keys) + self.waiting

    def add(self, phrases: list[np.ndarray]) -> None:
        """Counts phrases: the numbers of their first words, of their second words and so on."""
        self.container.append(phrases)
        self.waiting += len(phrases[0])
        if self.waiting > BURST:
            self.burst()

    def burst(self) -> None:
        """Counts what waits."""
        if self.container:
            first, *rest = (np.concatenate(c) for c in zip(*self.container))
            self.waiting, self.container = 0, []
            path = first.astype(np.int64)
            for level, column in zip(self.levels, rest):
                path = (path << _ID) | column
                if level is not self.levels[-1]:
                    path = level.number(path)
            self.levels[-1].count(path)

    def _columns(self, depth: int, keys: np.ndarray) -> list[np.ndarray]:
        """The words on the way to nodes of a level, first words first."""
        if self.words == 1:
            return [keys]
        out = []
        for level in reversed(self.levels[:depth]):
            out.append(keys & _WORD)
            keys = level.keys_of(keys >> _ID)
        return [keys >> _ID, keys & _WORD, *reversed(out)]

    def spill(self, down_to: int) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """Takes out the largest subtrees until ``down_to`` phrases are left: their words, as for ``add``, and their counts."""
        self.burst()
        if self.entries <= down_to:
            return
        first = [self._columns(depth, level.keys)[0] for depth, level in enumerate(self.levels)]
        sizes = np.bincount(first[-1])
        largest = np.argsort(-sizes, kind="stable")
        taken = np.searchsorted(np.cumsum(sizes[largest]), self.entries - down_to) + 1
        gone = np.zeros(len(sizes), bool)
        gone[largest[:taken]] = True
        left = [~gone[f] for f in first]
        leaves = self.levels[-1]
        out = np.flatnonzero(~left[-1])
        for at in range(0, len(out), ROWS):
            part = out[at : at + ROWS]
            yield self._columns(len(self.levels) - 1, leaves.keys[part]), leaves.values[part]
        for level, these in zip(self.levels, left):
            level.keep(these)


class _Words(dict):
    """Numbers of words by order of appearance; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_END: 0})
        self.listed, self.bytes = [_END], 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.listed)
        self.listed.append(word)
        self.bytes += len(word)
        return n


class Counter:
    """What a task has counted and not yet spilled."""

    def __init__(self, words: int, known: Bitmap | None):
        self.words, self.known = words, known
        self.numbers, self.tries = _Words(), {}
        self.hashes = np.zeros(1, np.uint64)

    def _hashed(self) -> np.ndarray:
        """The hashes of all numbered words."""
        if new := self.numbers.listed[len(self.hashes) :]:
            self.hashes = np.concatenate([self.hashes, np.fromiter(map(_word_hash, new), np.uint64, len(new))])
        return self.hashes

    def phrases(self, ids: np.ndarray, lang: str) -> list[np.ndarray]:
        """The phrases within pieces that may be frequent: their first words, their second words and so on."""
        n, words = len(ids) - self.words + 1, self.words
        if n <= 0:
            return [ids[:0]] * words
        good = ids[:n] > 0
        for k in range(1, words):
            good &= ids[k : n + k] > 0
        if self.known is not None:  # both phrases that are a word shorter must be known
            hashes = self._hashed()[ids]
            shorter = _extended(_seed(lang), hashes)
            for k in range(1, words - 1):
                shorter = _extended(shorter[: len(ids) - k], hashes[k:])
            held = self.known.holds(shorter)
            good &= held[:n] & held[1 : n + 1]
        at = np.flatnonzero(good)
        return [ids[at + k] for k in range(words)]

    def count(self, lang: str, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
        trie = self.tries.get(lang)
        if trie is None:
            trie = self.tries[lang] = Trie(self.words)
        last = np.zeros(0, np.int32)
        for raw, goes_on in _blocks(texts):
            words = _tokens(raw)
            numbers = map(self.numbers.__getitem__, words.dictionary.to_numpy(zero_copy_only=False).tolist())
            ids = np.fromiter(numbers, np.int32, len(words.dictionary))[words.indices.to_numpy()]
            if goes_on:
                ids = np.concatenate([last, ids])
            trie.add(self.phrases(ids, lang))
            last = ids[len(ids) - self.words + 1 :] if self.words > 1 else ids[:0]
            if len(self.numbers.listed) > NUMBERED or self.numbers.bytes > HELD:
                yield from self.emptied()
                trie = self.tries[lang] = Trie(self.words)
                last = np.array([self.numbers[w] for w in self.old(last)], np.int32)
            elif self.entries() > ENTRIES:
                yield from self.spilled(ENTRIES // 2)

    def entries(self) -> int:
        """The phrases held, once what waits has been counted if they seem too many."""
        if sum(t.entries for t in self.tries.values()) > ENTRIES:
            for trie in self.tries.values():
                trie.burst()
        return sum(t.entries for t in self.tries.values())

    def old(self, ids: np.ndarray) -> list[bytes]:
        """The words that numbers had before all was emptied."""
        return [self.before[i] for i in ids.tolist()]

    def spilled(self, down_to: int) -> Iterator[pa.RecordBatch]:
        """The phrases of the largest subtrees until ``down_to`` are left."""
        listed = pa.array(self.numbers.listed, pa.binary())
        left = self.entries()
        for lang, trie in sorted(self.tries.items(), key=lambda t: -t[1].entries):
            trie.burst()
            left -= (held := trie.entries)
            for columns, counts in trie.spill(max(down_to - left, 0)):
                held -= len(counts)
                yield _batch(lang, [listed.take(pa.array(c)) for c in columns], counts)
            left += held

    def emptied(self) -> Iterator[pa.RecordBatch]:
        yield from self.spilled(0)
        self.before = self.numbers.listed
        self.numbers, self.tries, self.hashes = _Words(), {}, np.zeros(1, np.uint64)


def _batch(lang: str, words: list[pa.Array], counts: np.ndarray) -> pa.RecordBatch:
    phrases = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary())).cast(pa.string())
    langs = pa.repeat(pa.scalar(lang, pa.string()), len(counts))
    return pa.RecordBatch.from_arrays([langs, phrases, pa.array(counts)], names=["lang", "phrase", "f"])


def counted(docs: DataFrame, words: int, known: Bitmap | None = None) -> DataFrame:
    """``lang, phrase, f`` of all phrases of ``words`` words in ``docs`` (``lang, text``), or of those that may be frequent."""
    told = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Counter(words, told.value)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                by_lang: dict[str, list] = {}
                for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                    by_lang.setdefault(lang, []).append(text)
                for lang, texts in by_lang.items():
                    yield from own.count(lang, texts)
        yield from own.emptied()

    runs = docs.mapInArrow(run, "lang string, phrase string, f long")
    prefix = F.substring_index("phrase", " ", max(words - 1, 2))
    dealt = runs.select("lang", prefix.alias("prefix"), F.expr("substr(phrase, length(prefix) + 1)").alias("rest"), "f").repartition("lang", "prefix")
    return dealt.groupBy("lang", "prefix", "rest").agg(F.sum("f").alias("f")).select("lang", F.concat("prefix", "rest").alias("phrase"), "f")


def bitmap(frequent: DataFrame) -> Bitmap:
    """The hashes of ``lang, phrase``, all of as many words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                langs = batch.column(0).dictionary_encode()
                value = np.concatenate([_seed(lang) for lang in langs.dictionary.to_pylist()])[langs.indices.to_numpy()]
                words = [w for phrase in batch.column(1).cast(pa.binary()).to_pylist() for w in phrase.split(b" ")]
                hashes = np.fromiter(map(_word_hash, words), np.uint64, len(words))
                for word in hashes.reshape(batch.num_rows, -1).T:  # all phrases are of one length
                    value = _extended(value, word)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64))], names=["hash"])

    return bitmaps.collect(frequent.select("lang", "phrase").mapInArrow(hashed, "hash long"), frequent.count())


def frequent_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of all phrases found ``least`` times or more, and ``lang, n`` of all words."""
    named = docs.select(F.coalesce(lang, F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    words = stage(counted(named, 1), "words")
    found = stage(words.where(F.col("f") >= least), "phrases")
    tables = [found.withColumn("words", F.lit(1))]
    for length in range(2, WORDS + 1):
        found = stage(counted(named, length, bitmap(found)).where(F.col("f") >= least), "phrases")
        tables.append(found.withColumn("words", F.lit(length)))
    phrases = tables[0]
    for table in tables[1:]:
        phrases = phrases.unionByName(table)
    return phrases, words.groupBy("lang").agg(F.sum("f").alias("n"))


def _part(phrase: Column, begin: Column, count: Column) -> Column:
    """``count`` words of a phrase from the ``begin``-th on, counted from 1."""
    return F.array_join(F.slice(F.split(phrase, " "), begin, count), " ")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the best phrases of each language."""
    phrases, sizes = frequent_phrases(docs, lang, text, least)
    longer = phrases.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"))
    cuts = longer.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    for side, begin, count in (("l", F.lit(1), F.col("k")), ("r", F.col("k") + 1, F.col("words") - F.col("k"))):
        facts = phrases.select("lang", F.col("phrase").alias("part"), F.col("f").alias(side))
        cuts = cuts.withColumn("part", _part(F.col("phrase"), begin, count)).join(facts, ["lang", "part"]).drop("part")
    score = F.expr(f"CAST((CAST({SCALE} AS DECIMAL(38,0)) * a) DIV (CAST(l AS DECIMAL(20,0)) + r) AS BIGINT)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # the shorter phrases inside each phrase of three words or more
    spans = F.expr("flatten(transform(sequence(2, words - 1), w -> transform(sequence(1, words - w + 1), s -> struct(s AS s, w AS w))))")
    inside = longer.where("words > 2").select("lang", "phrase", "a", F.explode(spans).alias("span"))
    covered = inside.select("lang", _part(F.col("phrase"), F.col("span.s"), F.col("span.w")).alias("phrase"), F.col("a").alias("f"))
    covered = covered.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    left = best.join(covered, ["lang", "phrase"], "left").where(
        F.expr(f"longer IS NULL OR CAST(100 AS DECIMAL(38,0)) * longer < CAST({COVERED} AS DECIMAL(38,0)) * a")
    )
    order = (F.desc("cut.score"), F.desc("a"), "phrase")
    share = F.pmod(F.xxhash64("phrase"), F.lit(SHARES))  # what is not among the best of its share is not among the best
    first = F.row_number().over(Window.partitionBy("lang", share).orderBy(*order))
    left = left.withColumn("rank", first).where(F.col("rank") <= top)
    ranked = left.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
