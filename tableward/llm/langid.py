"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams (one to three letters, words framed
by blanks) of a text in order.  A language's profile comes from all its training texts.
A document is compared to each by the out-of-place distance: for every n-gram of its own
profile the difference of the two ranks, or the profile's length where the language lacks
it.  The nearest language wins; of equally near ones the first by code point.

An n-gram is kept as one number, 21 bits a letter, so none are confused.  The score is
how much nearer the winner is than the next one, from 0 to 1; with one language it is
the share of the largest distance that is saved.  A text that is NULL or has no letter is
``und`` with score 0, as is every text if nothing could be learnt.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.session import stage

#: Longest n-gram, length of a profile, number of languages allowed (more are an error), remainder held out of three.
LONGEST, PROFILE, LANGUAGES, HELD_OUT = 3, 400, 1000, 1
#: N-grams counted in memory before they are handed on.
_HELD = 1 << 20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or 0."""
    table = np.zeros(0x110000, np.int64)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = c.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def grams(text: str | None) -> np.ndarray:
    """All n-grams of a text as numbers; a run of other characters counts as one blank, number 32."""
    points = _letters()[np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not points.any():
        return np.zeros(0, np.int64)
    framed = np.concatenate([[0], points, [0]])
    keep = framed != 0
    keep[0] = True
    keep[1:] |= framed[:-1] != 0
    line = framed[keep]
    line[line == 0] = 32
    parts, code = [line[line != 32]], line
    for n in range(2, LONGEST + 1):
        code = (code[:-1] << 21) | line[n - 1 :]
        # A blank may frame a word but not stand within an n-gram.
        inner = np.ones(len(code), bool)
        for k in range(1, n - 1):
            inner &= line[k : k + len(code)] != 32
        parts.append(code[inner])
    return np.concatenate(parts)


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(codes):
        return codes, codes
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.diff(np.append(first, len(codes)))


def profile_of(text: str | None, length: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, the most frequent first, of equally frequent ones the smaller number."""
    codes, n = counted(grams(text))
    return codes[np.argsort(-n, kind="stable")[:length]]


def held_out(doc_id: Column) -> Column:
    """Whether a document must not be learnt from; one without id may be."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == HELD_OUT, F.lit(False))


def learn(labelled: DataFrame, text: str, lang: str, length: int = PROFILE) -> DataFrame:
    """One row per language and place: ``lang, gram, place`` from 0, from all texts with a language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                codes, n = counted(np.concatenate(parts))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(n, pa.int64())], ["lang", "gram", "n"]
                )

        held, size = {}, 0
        for batch in batches:
            for name, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes = grams(t)
                held.setdefault(name, []).append(codes)
                size += len(codes)
                if size > _HELD:
                    yield from out(held)
                    held, size = {}, 0
        yield from out(held)

    known = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    sums = known.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    return sums.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < length).select("lang", "gram", "place")


class Profiles:
    """The languages' profiles as a matrix: a row per known n-gram, a column per language."""

    def __init__(self, rows: list[tuple[str, int, int]], length: int):
        self.length, self.names = length, sorted({r[0] for r in rows})
        self.codes = np.array(sorted({r[1] for r in rows}), np.int64)
        self.places = np.full((len(self.codes) + 1, len(self.names)), -1, np.int32)  # the last row is an n-gram no language has
        for name, code, place in rows:
            self.places[np.searchsorted(self.codes, code), self.names.index(name)] = place

    def nearest(self, text: str | None) -> tuple[str, float]:
        own = profile_of(text, self.length)
        if not len(own) or not self.names:
            return "und", 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        places = self.places[np.where(self.codes[at] == own, at, len(self.codes))]
        apart = np.where(places < 0, self.length, np.abs(places - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(apart.argmin())
        rest = np.delete(apart, best)
        second = rest.min() if len(rest) else self.length * len(own)
        return self.names[best], float((second - apart[best]) / second) if second else 0.0


def predict(docs: DataFrame, profiles: DataFrame, text: str = "text", length: int = PROFILE) -> DataFrame:
    """``docs`` with the struct ``_found`` of ``lang_pred, score``, by profiles as ``learn`` gives them."""
    profiles = stage(profiles, "profiles")
    n = profiles.agg(F.countDistinct("lang")).first()[0]
    if n > LANGUAGES:
        raise ValueError(f"{n} languages to learn, {LANGUAGES} are allowed")
    known = Profiles([tuple(r) for r in profiles.collect()], length)  # at most LANGUAGES x length rows
    shared = docs.sparkSession.sparkContext.broadcast(known)

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def find(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.nearest(t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn("_found", find(F.col(text)))


def identify(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lang: str = "lang") -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``; learns from those not held out."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text"), held_out(F.col(doc_id)).alias("held_out"))
    profiles = learn(slim.where(~F.col("held_out")), "text", "lang")
    return predict(slim.drop("lang"), profiles).select("doc_id", "held_out", "_found.lang_pred", "_found.score")
