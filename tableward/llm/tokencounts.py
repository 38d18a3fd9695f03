"""Token counts of every prefix of a text, by dynamic programming over a piece vocabulary.

A BPE encoding is the only way to cut a text into pieces such that each two neighbours,
encoded together, stay as they are: any merge across a boundary would already happen
between the two pieces at it.  So the last piece of each prefix is the one piece that ends
there and can follow the last piece of what is before it, and the count is one more than
there.  One walk over a text gives the count of every prefix, and with it the answer to
any question on truncation or budgets, without encoding again.

Two characters that stand side by side in no piece are never merged.  Texts fall apart
between such characters into stretches that don't depend on each other, words mostly; each
worker keeps the counts of stretches it has met in a bounded cache.  Characters outside the
vocabulary count one token per byte.

``counts[i]`` belongs to the first i code points, ``counts[0]`` is 0.  NULL text is empty;
texts of any length are walked in parts; repeated rows are counted each by itself.  Other
columns pass through unchanged; ``into`` must not be one of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.llm.common import let

#: The blank as pieces write it.
BLANK = "▁"
#: Stretches and pairs a worker keeps; stretches of a text walked at a time; rows and characters handed on at a time.
CACHED, PAIRS, STRETCHES, ROWS, CHARACTERS = 400_000, 1_000_000, 1 << 16, 128, 1 << 20
_BPE, _NORMAL, _SKIPPED = 2, 1, {2, 3, 6}  # fixed values of the model file: the kind of model and of pieces


class Pieces:
    """The pieces of a model and the counts of prefixes they give."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        told = sentencepiece_model_pb2.ModelProto()
        told.ParseFromString(model)
        rule = told.normalizer_spec
        plain = not rule.precompiled_charsmap and rule.escape_whitespaces and not rule.remove_extra_whitespaces
        if told.trainer_spec.model_type != _BPE or not told.trainer_spec.byte_fallback or not plain or told.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with byte fallback that leave texts as they are can be counted")
        if strange := {p.type for p in told.pieces} - {_NORMAL} - _SKIPPED:
            raise ValueError(f"pieces of kind {sorted(strange)} are not known")
        self.first = BLANK if rule.add_dummy_prefix else ""
        self.scores = {p.piece: p.score for p in told.pieces if p.type == _NORMAL}
        self.longest = max(map(len, self.scores), default=1)
        # characters of pieces are numbered from 1, others are 0; which numbers stand side by side
        number = {c: i for i, c in enumerate(sorted(set("".join(self.scores))), 1)}
        self.numbers = np.zeros(max(map(ord, number), default=0) + 2, np.int32)
        self.numbers[[ord(c) for c in number]] = list(number.values())
        self.beside = np.zeros((len(number) + 1, len(number) + 1), bool)
        for a, b in {pair for p in self.scores for pair in zip(p, p[1:])}:
            self.beside[number[a], number[b]] = True
        self.pairs: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}
        self.whole = {p for p in self.scores if len(p) == 1 or self.merged(p) == [p]}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: the neighbours of best score are joined, the leftmost of equals, until none are left."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            found = [(-s, i) for i in range(len(parts) - 1) if (s := scores.get(parts[i] + parts[i + 1])) is not None]
            if not found:
                break
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def follows(self, left: str, right: str) -> bool:
        """Whether two pieces stay apart when they are encoded together."""
        key = left, right
        if (known := self.pairs.get(key)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(left + right) == [left, right]
        return known

    def walk(self, stretch: str) -> bytes:
        """The counts of a stretch's prefixes from one character on, as the bytes of 32-bit numbers."""
        whole, longest, pairs = self.whole, self.longest, self.pairs
        last, counts = [""], [0]
        for end in range(1, len(stretch) + 1):
            for start in range(max(end - longest, 0), end):
                piece = stretch[start:end]
                if piece in whole:
                    before = last[start]
                    if not start or pairs.get((before, piece)) or self.follows(before, piece):
                        last.append(piece)
                        counts.append(counts[start] + 1)
                        break
            else:  # a character outside the vocabulary
                last.append(stretch[end - 1])
                counts.append(counts[end - 1] + len(stretch[end - 1].encode("utf-8", "surrogatepass")))
        return np.array(counts[1:], np.int32).tobytes()

    def _joined(self, stretches: list[str], base: int) -> np.ndarray:
        """The counts of stretches one after the other, from ``base`` on."""
        known = self.known
        if len(known) > CACHED:
            known.clear()
        for s in set(stretches).difference(known):
            known[s] = self.walk(s)
        found = list(map(known.__getitem__, stretches))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        counts = np.frombuffer(b"".join(found), np.int32)
        ends = np.cumsum(lengths)
        before = np.concatenate([[base], base + np.cumsum(counts[ends - 1])[:-1]])
        return counts + np.repeat(before, lengths).astype(np.int32)

    def _starts(self, text: str) -> np.ndarray:
        """Where the stretches of a text begin, and its length."""
        found = [np.zeros(1, np.int64)]
        for at in range(0, len(text), CHARACTERS):
            code = np.frombuffer(text[at : at + CHARACTERS + 1].encode("utf-32-le", "surrogatepass"), np.uint32)
            number = self.numbers[np.minimum(code, len(self.numbers) - 1)]
            found.append(np.flatnonzero(~self.beside[number[:-1], number[1:]]) + (at + 1))
        return np.concatenate([*found, [len(text)]])

    def counts(self, text: str | None) -> np.ndarray:
        """The counts of all prefixes of a text, the empty one first."""
        if not text:
            return np.zeros(1, np.int32)
        marked = self.first + text.replace(" ", BLANK)
        starts = self._starts(marked)
        parts, base = [], 0
        for at in range(0, len(starts) - 1, STRETCHES):
            some = starts[at : at + STRETCHES + 1].tolist()
            parts.append(self._joined([marked[i:j] for i, j in zip(some, some[1:])], base))
            base = int(parts[-1][-1])
        out = np.concatenate(parts)
        out = out[1:] if self.first else out
        return np.concatenate([np.zeros(1, np.int32), out])


@lru_cache(maxsize=2)
def _pieces(digest: str, model: bytes) -> Pieces:
    return Pieces(model)


def pieces(model: bytes) -> Pieces:
    return _pieces(hashlib.sha256(model).hexdigest(), model)


def _slices(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches of some rows and characters; a long text is alone."""
    for batch in batches:
        at, held = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
        for i, size in enumerate(sizes):
            if i > at and (held + size > CHARACTERS or i - at >= ROWS):
                yield batch.slice(at, i - at)
                at, held = i, 0
            held += size
        if at < batch.num_rows:
            yield batch.slice(at)


def prefix_counts(df: DataFrame, model: str, text: str = "text", into: str = "counts") -> DataFrame:
    """``df`` with the token counts of all prefixes of ``text`` as an array of int in ``into``.

    ``model`` is the path of a piece model.  The driver reads it, and it travels with the
    tasks; it has the size of a vocabulary, whatever the size of ``df``.
    """
    if into.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"{into} is a column already")
    with open(model, "rb") as file:
        told = df.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = pieces(told.value)
        for batch in _slices(batches, text):
            found = [own.counts(t) for t in batch.column(text).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(c) for c in found])]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, into])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(into, T.ArrayType(T.IntegerType()))]))


def total(counts: Column) -> Column:
    """The tokens of the whole text."""
    return F.element_at(counts, -1)


def tokens_within(counts: Column, characters: Column) -> Column:
    """The tokens of the first ``characters`` code points, of the whole text where it is shorter."""
    return F.element_at(counts, F.least(F.greatest(characters, F.lit(0)), F.size(counts) - 1) + 1)


def characters_within(counts: Column, budget: int) -> Column:
    """The code points of the longest prefix of at most ``budget`` tokens."""
    places = F.transform(counts, lambda c, i: F.when(c <= budget, i).otherwise(0))
    return F.when(total(counts) <= budget, F.size(counts) - 1).otherwise(let(places, F.array_max))


def truncated(text: Column, counts: Column, budget: int) -> Column:
    """The longest prefix of a text with at most ``budget`` tokens; NULL stays NULL."""
    return F.substring(text, F.lit(1), characters_within(counts, budget))
