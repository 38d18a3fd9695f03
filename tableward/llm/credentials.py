"""Secrets in texts: fixed patterns, and weak candidates that only count together.

``found_in`` lists what stands in one text.  Spans of the fixed patterns are always
reported.  Everything else is a part of a possible credential: an access identifier, a
secret or an endpoint, often too weak to report alone.  Parts are joined as intervals: a weak identifier
or secret is reported when a part of the complementary role starts within ``SCOPE``
characters of it in the same document; an endpoint when both do.

The join works on bins of ``SCOPE`` characters: a bin keeps the first and the last start of
each role, and a part asks its own bin and the two beside it.  So a document with many
parts makes three rows a bin and role, never pairs of parts.

NULL text is empty.  Positions are code points, ends exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableward.session import stage

#: Characters between the starts of parts that belong together.
SCOPE = 300
KINDS = ("assign", "access", "hex", "id_part", "secret_part", "endpoint_part")
#: Fixed patterns.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # the whole run, as 18 or more characters are asked for
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGNED = 12
#: Parts: names of identifiers, of secrets, of endpoints, each with a value; a URL; a mixed token.
_VALUE = r"[\"']?\x20?[:=]\x20?[\"']?([A-Za-z0-9+/_.@%:\-]{4,}+)"
ID_PART = re.compile(r"\b(?:access_?key_?id|client_?id|user(?:name)?|login|account)" + _VALUE, re.IGNORECASE | re.ASCII)
SECRET_PART = re.compile(r"\b(?:pass(?:word|wd|phrase)?|pwd|secret|token|api_?key|private_?key|auth)" + _VALUE, re.IGNORECASE | re.ASCII)
ENDPOINT_PART = re.compile(
    r"\b(?:https?|jdbc|postgres|mysql|mongodb|redis|amqp|s3|ftp)[:a-z]*://[^\s\"'<>]{3,}+|\b(?:host|endpoint|region|server)" + _VALUE, re.ASCII
)
TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+")
_HINT = re.compile(r"AKIA|[:=]|[A-Za-z0-9+/_-]{24}")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The fixed patterns' spans, by start, then kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def mixed(token: str) -> bool:
    """Whether a token has small and capital letters and several digits, as keys have and words have not."""
    return sum(c.isdigit() for c in token) >= 4 and token.lower() != token and token.upper() != token


def parts(text: str, base: list[Span]) -> list[Span]:
    """Parts in a text; what is weaker gives way to what it overlaps."""
    if not _HINT.search(text):
        return []
    weak = [("id_part", *m.span()) for m in ID_PART.finditer(text)]
    weak += [("secret_part", *m.span()) for m in SECRET_PART.finditer(text)]
    weak += [("endpoint_part", *m.span()) for m in ENDPOINT_PART.finditer(text)]
    weak += [("secret_part", *m.span()) for m in TOKEN.finditer(text) if mixed(m[0])]
    strong = {"access": "id_base", "assign": "secret_base", "hex": "secret_base"}
    ranked = [(0, s, e, strong[k]) for k, s, e in base] + [(1, s, e, k) for k, s, e in weak]
    free, ends = [], []
    for rank, s, e, k in sorted(ranked, key=lambda r: (r[1], r[0], -r[2])):
        if rank == 0 or not ends or s >= ends[-1]:
            free.append((k, s, e))
            ends.append(max(e, ends[-1] if ends else 0))
    covered = [(s, e) for k, s, e in free if k.endswith("base")]
    at, out = 0, []
    for k, s, e in free:  # a weak part that a later strong one overlaps goes too
        while at < len(covered) and covered[at][1] <= s:
            at += 1
        if k.endswith("base") or at == len(covered) or covered[at][0] >= e:
            out.append((k, s, e))
    return out


_SPANS = "array<struct<kind:string,start:int,end:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def found_in(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text``) as ``doc_id, base, parts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            more = [parts(t, b) for t, b in zip(texts, base)]
            listed = [
                pa.array([[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in column], _SPAN_TYPE) for column in (base, more)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *listed], ["doc_id", "base", "parts"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, base {_SPANS}, parts {_SPANS}")


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Of ``row, kind, start, end`` the weak parts whose complement is in scope."""
    role = F.split("kind", "_")[0]
    parts = parts.withColumns({"role": role, "bin": F.floor(F.col("start") / scope)})
    bins = parts.groupBy("row", "bin", "role").agg(F.min("start").alias("first"), F.max("start").alias("last"))
    seen = bins.select(
        "row", F.explode(F.array(F.col("bin") - 1, F.col("bin"), F.col("bin") + 1)).alias("bin"), F.col("role").alias("other"), "first", "last"
    )
    wanted = {"id": ("secret",), "secret": ("id",), "endpoint": ("id", "secret")}
    asked = F.create_map(*[x for k, v in wanted.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    weak = parts.where(F.col("kind").endswith("_part"))
    # Both ends of a bin are tried: before this part its last start is nearest, after it its first.
    near = (F.abs(F.col("first") - F.col("start")) <= scope) | (F.abs(F.col("last") - F.col("start")) <= scope)
    met = weak.join(seen, ["row", "bin"]).where(F.array_contains(asked[F.col("role")], F.col("other")) & near)
    roles = met.groupBy("row", "kind", "role", "start", "end").agg(F.count_distinct("other").alias("n"))
    return roles.where(F.col("n") == F.size(asked[F.col("role")])).select("row", "kind", "start", "end")


def listed(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def by_start(spans: Column) -> Column:
    place = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), place(s).alias("place"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.transform(F.sort_array(keyed), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def secrets(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``base`` and ``spans`` (all), arrays of ``kind, start, end``."""
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = stage(found_in(slim).withColumn("row", F.monotonically_increasing_id()), "secrets")
    exploded = found.select("row", F.explode("parts").alias("p")).select("row", "p.*")
    more = linked(exploded).groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    empty = F.array().cast(_SPANS)
    joined = found.select("row", "doc_id", "base").join(more, "row", "left")
    return joined.select("doc_id", "base", by_start(F.concat("base", F.coalesce("more", empty))).alias("spans"))


def counted(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digests(found: DataFrame) -> DataFrame:
    """Counts of the fixed patterns, their digest, and all spans as text."""
    return found.select(
        "doc_id", *[counted(F.col("base"), k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )
