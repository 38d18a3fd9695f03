"""Personal data in texts: fixed patterns, and what a semi-Markov CRF adds to them.

The fixed patterns' spans are always reported.  Around what could be personal data (an
``@``, a run of digits and the signs numbers are written with) short runs are cut out; a CRF
(``semicrf``) labels their segments and adds those it is sure of and that lie over no fixed span.

The CRF is trained here, on ``TRAINING`` runs at most, chosen by a hash: the patterns' spans
are its entities.  In each training round some features are hidden, so that no single sign, such
as the plus of a phone number, is necessary.  Copies of the runs with a changed digit, without
dots, and with bare digits only teach it what is no entity.  Apart from that bounded sample every run of every text is used.

NULL text is empty.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.llm.semicrf import Model, luhn, train
from tableward.session import stage

KINDS = ("email", "ip", "card", "phone")
#: Runs the model is trained on at most, the probability it must reach, characters of a run on either side of an ``@``.
TRAINING, CERTAIN, REACH = 150, 0.9, 64
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3,}")  # possessive: a long number is passed over once
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"[+(]?[0-9][0-9\x20().+-]*[0-9]")
_BEFORE, _AFTER = re.compile(r"[^\s@]*\Z"), re.compile(r"[^\s@]*")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The matches of local part, ``@`` and dotted domain, leftmost first; linear however long a word is."""
    at, free = text.find("@"), 0
    while at >= 0:
        local = text[free:at]
        start = free + len(local.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        free = found.end() if found else at + 1
        if found:
            yield start, free
        at = text.find("@", free)


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Four dotted numbers each; a longer chain is taken four by four."""
    for chain in _DOTTED.finditer(text):
        numbers = list(re.finditer(r"[0-9]+", chain[0]))
        for k in range(0, len(numbers) - 3, 4):
            four = numbers[k : k + 4]
            if all(len(n[0].lstrip("0")) <= 3 and int(n[0].lstrip("0") or 0) <= 255 for n in four):
                yield chain.start() + four[0].start(), chain.start() + four[3].end()


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans, by kind, then start."""
    return [
        *(("email", s, e) for s, e in emails(text)),
        *(("ip", s, e) for s, e in ips(text)),
        *(("card", *m.span()) for m in _CARD.finditer(text) if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)),
        *(("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15),
    ]


def runs(text: str) -> list[tuple[int, str]]:
    """Where personal data could be: start and text of each run, none over another."""
    found = []
    at = text.find("@")
    while at >= 0:
        before = _BEFORE.search(text[max(at - REACH, 0) : at])
        after = _AFTER.match(text[at + 1 : at + 1 + REACH])
        found.append((at - len(before[0]), at + 1 + len(after[0])))
        at = text.find("@", at + 1)
    mail = 0
    for m in _NUMBER.finditer(text):
        s, e = m.span()
        if sum("0" <= c <= "9" for c in m[0]) >= 7 or m[0].count(".") >= 3:
            while mail < len(found) and found[mail][1] <= s:
                mail += 1
            if mail == len(found) or found[mail][0] >= e:
                found.append((s, e)) if not found or s >= found[-1][1] else found.insert(mail, (s, e))
    out, free = [], 0
    for s, e in sorted(found):
        s = max(s, free)
        if s < e:
            out.append((s, text[s:e]))
            free = e
    return out


_SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN_TYPE = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_FOUND = f"base {_SPANS}, runs array<struct<start:int,text:string>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_RUN = pa.struct([("start", pa.int32()), ("text", pa.string())])


def found_in(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text``) as ``doc_id, base, runs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [[dict(zip(("kind", "start", "end"), s)) for s in base_spans(t)] for t in texts]
            cut = [[dict(zip(("start", "text"), r)) for r in runs(t)] for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(_SPAN)), pa.array(cut, pa.list_(_RUN))], ["doc_id", "base", "runs"]
            )

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_FOUND}")


def taught(texts: list[str]) -> list[tuple[str, list[Span]]]:
    """Training runs: as they are, with the last digit changed, without dots, and with bare digits only."""
    changed = [re.sub(r"[0-9](?=[^0-9]*\Z)", lambda m: str((int(m[0]) + 1) % 10), t) for t in texts]
    bare = [_digits(t)[:15] for t in texts if "@" not in t]
    return [(t, base_spans(t)) for t in dict.fromkeys((*texts, *changed, *(t.replace(".", "") for t in texts), *bare)) if t]


def learn(found: DataFrame, most: int = TRAINING) -> Model:
    """A model from at most ``most`` different runs, those with the smallest hashes."""
    each = found.select(F.explode("runs.text").alias("text")).where(F.length("text") <= 4 * REACH).distinct()
    sample = each.orderBy(F.xxhash64("text"), "text").limit(most).collect()  # at most `most` short texts
    return train(taught([r[0] for r in sample]))


def added(found: DataFrame, model: Model, certain: float = CERTAIN) -> DataFrame:
    """``found`` with ``more``: what the model adds to ``base``."""
    shared = found.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(_SPAN_TYPE)
    def label(base: pd.Series, cut: pd.Series) -> pd.Series:
        out = []
        for known, some in zip(base, cut):
            taken = sorted((s["start"], s["end"]) for s in known)
            more, at, high = [], 0, 0
            for run in some:
                for kind, s, e in shared.value.decode(run["text"], certain):
                    s, e = run["start"] + s, run["start"] + e
                    while at < len(taken) and taken[at][0] < e:
                        high, at = max(high, taken[at][1]), at + 1
                    if high <= s:
                        more.append({"kind": kind, "start": s, "end": e})
            out.append(more)
        return pd.Series(out)

    return found.withColumn("more", label("base", "runs"))


def by_kind(spans: Column) -> Column:
    place = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(place(s).alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.sort_array(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def personal_data(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``spans`` (all), arrays of ``kind, start, end``."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = stage(found_in(slim), "personal")  # the texts are read once; what follows sees spans and runs only
    return added(found, learn(found)).select("doc_id", "base", by_kind(F.concat("base", "more")).alias("spans"))
