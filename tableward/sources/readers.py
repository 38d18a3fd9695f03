"""Readers: CSV, JSON, delimited and plain text, Excel, XML.

Files are grouped by layout (separator, encoding, header) and each layout is
one Spark read, so the number of jobs follows the number of different layouts,
not of files.  What a layout is comes from one pass over the raw lines.
"""

from __future__ import annotations

import csv
import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableward.config import CSV_NULL_TOKENS, DEFAULTS, TEXT_DELIMITERS, QualityConfig
from tableward.functions.columns import col
from tableward.functions.names import _unique
from tableward.functions.scalars import WHITESPACE, strip
from tableward.operators.explore import flatten
from tableward.operators.missing import replace_null_tokens
from tableward.operators.textclean import infer_reader_types
from tableward.session import place, stage
from tableward.sources.excel import read_sheets

LATIN = "ISO-8859-1"
PATH = "_source_path"
#: Up to so many paths are given to Spark one by one; it lists more of them in a job with a task for each.
_FEW = 32


@dataclass(frozen=True)
class Layout:
    kind: str
    sep: str = ","
    encoding: str = "UTF-8"
    header: str = ""
    multi_line: bool = False


@dataclass
class Loaded:
    """One layout's rows, the files they come from, and files that failed."""

    dataset: str
    layout: Layout
    paths: list[str]
    rows: DataFrame | None
    errors: dict[str, str] = field(default_factory=dict)
    trimmed: bool = False  # columns without a value are gone already


def file_path() -> Column:
    """The path of the row's file as listings show it; metadata paths are percent-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def literal(paths: Sequence[str]) -> list[str]:
    """Paths that the reader takes as they are, whatever glob characters they hold."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]


def located(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """What the reader is given for ``paths``: a folder of which all entries are among them instead of each of its files."""
    if len(paths) <= _FEW:
        return literal(paths)
    folders: dict[str, set[str]] = {}
    for p in paths:
        folders.setdefault(p.rsplit("/", 1)[0], set()).add(p)
    jvm, conf, found = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for folder, members in folders.items():
        entries = 0
        if len(members) > _FEW:
            shown = jvm.org.apache.hadoop.fs.Path(literal([folder])[0] + "/[^_.]*")
            entries = len(shown.getFileSystem(conf).globStatus(shown) or ())
        found += literal([folder] if entries == len(members) else sorted(members))
    return found


def _decoded(line: Column, valid: Column) -> Column:
    return F.when(valid, line).otherwise(F.decode(line.cast("binary"), LATIN))


def decode_with_fallback(content: Column) -> Column:
    """Bytes as UTF-8 when they are UTF-8, else as Latin-1, which accepts any byte."""
    text = content.cast("string")
    return _decoded(text, F.is_valid_utf8(text))


def _lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Raw lines with their file and place; the text source leaves the bytes as they are."""
    return spark.read.text(located(spark, paths)).select(
        file_path().alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        "value",
    )


def _unquoted(line: Column) -> Column:
    return F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, '"[^"]*"', "")).otherwise(line)


def _count(line: Column, mark: str) -> Column:
    return F.char_length(line) - F.char_length(F.replace(line, F.lit(mark), F.lit("")))


def sniff(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Encoding, first line, and field counts of each text file, in one pass.

    A task holds one entry per file.  Without ``collect_set`` Spark would sort all
    lines by file to find the first, as it can't keep text in its other hash table.
    """
    lines = _lines(spark, paths).withColumn("bare", _unquoted(F.col("value")))
    filled = F.btrim("value", F.lit(WHITESPACE)) != ""
    seps = (",", *TEXT_DELIMITERS)
    found = lines.groupBy("path").agg(
        (~F.array_contains(F.collect_set(F.is_valid_utf8("value")), F.lit(False))).alias("utf8"),
        F.min_by("value", F.when(filled, F.struct("block", "at"))).alias("first"),
        F.bool_or(_count(F.col("value"), '"') % 2 == 1).alias("open_quotes"),
        *[F.max(_count(F.col("bare"), s)).alias(f"most_{i}") for i, s in enumerate(seps)],
    )
    header = F.regexp_replace(_decoded(F.col("first"), F.col("utf8")), "^\ufeff|\r$", "")
    for i, s in enumerate(seps):
        in_first = F.contains(header, F.lit(s))
        fits = F.col("open_quotes") | (F.col(f"most_{i}") <= _count(_unquoted(header), s))
        found = found.withColumn(f"in_{i}", in_first).withColumn(f"fits_{i}", fits)
    text_sep = F.coalesce(
        *[F.when(F.col(f"in_{i}") & F.col(f"fits_{i}"), F.lit(s)) for i, s in enumerate(seps) if i],
    )
    return found.select(
        "path",
        F.when(F.col("utf8"), F.lit("UTF-8")).otherwise(F.lit(LATIN)).alias("encoding"),
        header.alias("header"),
        "open_quotes",
        F.col("fits_0").alias("csv_fits"),
        text_sep.alias("text_sep"),
    ).where(F.col("header").isNotNull())


def header_names(header: str, sep: str) -> list[str]:
    cells = next(csv.reader([header], delimiter=sep), [])
    return _unique(c if c != "" else f"Unnamed: {i}" for i, c in enumerate(cells))


def read_delimited(
    spark: SparkSession, paths: Sequence[str], layout: Layout, cfg: QualityConfig = DEFAULTS
) -> DataFrame:
    """Delimited files of one layout as text columns plus the file path."""
    names = header_names(layout.header, layout.sep)
    schema = ", ".join("`" + n.replace("`", "``") + "` string" for n in names)
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("sep", layout.sep)
        .option("encoding", layout.encoding)
        .option("escape", '"')
        .option("multiLine", str(layout.multi_line).lower())
        .csv(located(spark, paths))
        .select(*[col(n) for n in names], file_path().alias(PATH))
    )


def with_reader_types(df: DataFrame, cfg: QualityConfig = DEFAULTS) -> DataFrame:
    """What a typed text reader adds: null markers, numbers, booleans.

    The pass that finds the types also finds columns without a value; they are
    dropped here, which saves the ingest flow a pass of its own.
    """
    names = [c for c in df.columns if c != PATH]
    marks = tuple(dict.fromkeys((*CSV_NULL_TOKENS, *cfg.null_tokens)))
    return infer_reader_types(replace_null_tokens(df, cfg, marks, names), cfg, names, drop_empty=True)


def read_json(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """JSON objects and arrays of objects, one row per object; and the files
    that are no such JSON, as ``path``.  ``documents`` has one file's ``path, text`` a row.

    The schema is found on the documents as one line each: the multi-line reader
    would look for it file by file, in time that grows with the square of their number.
    """
    spark = documents.sparkSession
    lines = place(spark, "json-lines")
    documents.select(F.translate("text", "\r\n", "  ").alias("value")).write.text(lines)
    schema = spark.read.option("columnNameOfCorruptRecord", "_corrupt").json(lines).drop("_corrupt").schema
    parsed = documents.select(F.from_json("text", T.ArrayType(schema)).alias("rows"), F.col("path").alias(PATH))
    broken = parsed.where(F.col("rows").isNull()).select(F.col(PATH).alias("path")).distinct()
    return flatten(parsed.select(F.explode("rows").alias("row"), PATH).select("row.*", PATH)), broken


def read_json_values(documents: DataFrame) -> DataFrame:
    """Bare JSON values and arrays of them: column ``data``, one row per value."""
    wrapped = F.concat(F.lit('{"data":'), F.col("text"), F.lit("}"))
    many = F.from_json(wrapped, "data array<string>")["data"]
    one = F.array(F.from_json(wrapped, "data string")["data"])
    values = F.when(F.startswith("text", F.lit("[")), many).otherwise(one)
    return documents.select(F.explode_outer(values).alias("data"), F.col("path").alias(PATH))


def _is_one_document(content: Column) -> Column:
    """Whether a text is exactly one JSON value.

    The parser ignores what follows a value; no such rest can be well-formed
    both inside an array and inside an object.
    """
    wrapped = [F.concat(F.lit(a), content, F.lit(b)) for a, b in (("[", "]"), ('{"data":', "}"))]
    return F.try_parse_json(wrapped[0]).isNotNull() & F.try_parse_json(wrapped[1]).isNotNull()


def json_documents(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, encoding, shape, text`` of each file: whether it holds objects, bare values or no JSON.

    A file is one document: several in a row are not JSON, and the multi-line
    reader would stop after the first of them without a word.  Only formats
    under the size guard come here, so a file fits a row.
    """
    valid = F.is_valid_utf8("value")
    whole = spark.read.text(located(spark, paths), wholetext=True).select(
        file_path().alias("path"),
        F.when(valid, F.lit("UTF-8")).otherwise(F.lit(LATIN)).alias("encoding"),
        strip(_decoded(F.col("value"), valid)).alias("text"),
    )
    content = F.col("text")
    start = F.substring(F.regexp_replace(content, r"^\[\s*", "["), 1, 2)
    objects = start.startswith("{") | (start == "[{") | (start == "[]")
    shape = F.when(~_is_one_document(content), F.lit("invalid")).when(objects, F.lit("objects")).otherwise(F.lit("values"))
    return whole.select("path", "encoding", shape.alias("shape"), "text")


def read_plain_text(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Lines with their number, the text as a whole stripped first.

    Numbers come from the line counts of the file's splits plus the place
    within the split, so a single huge file is numbered by many tasks.
    """
    raw = _lines(spark, paths)
    valid = F.is_valid_utf8("value")
    lines = raw.withColumn("text", _decoded(F.col("value"), valid)).drop("value")
    blank = F.btrim("text", F.lit(WHITESPACE)) == ""
    place = F.struct("block", "at")
    ends = lines.where(~blank).groupBy("path").agg(F.min(place).alias("head"), F.max(place).alias("tail"))
    inner = lines.join(ends, "path").where((place >= F.col("head")) & (place <= F.col("tail")))
    sizes = inner.groupBy("path", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("path", "block", before.alias("before"))
    within = F.row_number().over(W.partitionBy("path", "block").orderBy("at"))
    text = F.when(place == F.col("head"), F.ltrim("text", F.lit(WHITESPACE))).otherwise(F.col("text"))
    text = F.when(place == F.col("tail"), F.rtrim(text, F.lit(WHITESPACE))).otherwise(text)
    return inner.withColumn("within", within).join(offsets, ["path", "block"]).select(
        text.alias("text_content"), (F.col("before") + F.col("within")).alias("line_number"), F.col("path").alias(PATH)
    )


def split_lines(df: DataFrame, column: str, keep: Sequence[str] = ()) -> DataFrame:
    """Texts already in a table, one row per line, numbered from 1."""
    return df.select(
        *[col(c) for c in keep], F.posexplode(F.split(strip(col(column)), "\n")).alias("pos", "text_content")
    ).select(*[col(c) for c in keep], "text_content", (F.col("pos") + 1).alias("line_number"))


def read_excel(spark: SparkSession, paths: Sequence[str]) -> Iterator[tuple[str, list[str], DataFrame | None, dict[str, str]]]:
    """Workbooks by header: header, files, rows, errors."""
    files = spark.read.format("binaryFile").load(literal(paths))
    # each workbook is parsed once, then read by header
    rows = stage(read_sheets(files, min(len(paths), 10_000)), "sheets")
    heads = rows.groupBy("path").agg(F.max("header").alias("header"), F.max("error_message").alias("error_message")).collect()
    errors = {r["path"]: r["error_message"] for r in heads if r["error_message"]}
    by_header: dict[str, list[str]] = {}
    for r in heads:
        if not r["error_message"]:
            by_header.setdefault(r["header"], []).append(r["path"])
    for header, members in by_header.items():
        names = _unique(json.loads(header))
        cells = rows.where(F.col("header") == header).select(
            *[F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(names)], F.col("path").alias(PATH)
        )
        yield header, members, cells, {}
    if errors:
        yield "", list(errors), None, errors


def read_xml(spark: SparkSession, paths: Sequence[str], row_tag: str) -> DataFrame:
    """XML records of one tag."""
    raw = spark.read.option("rowTag", row_tag).xml(literal(paths))
    return flatten(raw.withColumn(PATH, file_path()))


def load(spark: SparkSession, files: DataFrame, cfg: QualityConfig = DEFAULTS) -> Iterator[Loaded]:
    """Read the files of a manifest, one frame per dataset and layout.

    The driver holds file names only, as Spark's own file index does.
    """
    listed = files.select("path", "kind", "dataset").collect()
    home = {r["path"]: r["dataset"] for r in listed}
    kinds: dict[str, list[str]] = {}
    for r in listed:
        kinds.setdefault(r["kind"], []).append(r["path"])

    delimited = kinds.get("csv", []) + kinds.get("text", [])
    csv_files = set(kinds.get("csv", []))
    groups: dict[tuple[str, Layout], list[str]] = {}
    failed: dict[str, str] = {}
    if delimited:
        seen = {r["path"]: r for r in sniff(spark, delimited).collect()}
        for path in delimited:
            s = seen.get(path)
            if s is None:
                failed[path] = "no lines to read"
                continue
            if path in csv_files:
                if not s["csv_fits"]:
                    failed[path] = "a row holds more fields than the header"
                    continue
                layout = Layout("csv", ",", s["encoding"], s["header"], s["open_quotes"])
            elif s["text_sep"]:
                layout = Layout("csv", s["text_sep"], s["encoding"], s["header"], s["open_quotes"])
            else:
                layout = Layout("lines", "", s["encoding"])
            groups.setdefault((home[path], layout), []).append(path)
    documents = None
    if kinds.get("json"):
        # read once, whatever layouts there are; the file names are on the driver already
        datasets = F.broadcast(files.select("path", "dataset").dropDuplicates(["path"]))
        documents = stage(json_documents(spark, kinds["json"]).join(datasets, "path"), "json")
        for r in documents.select("path", "encoding", "shape").collect():
            if r["shape"] == "invalid":
                failed[r["path"]] = "invalid JSON"
                continue
            groups.setdefault((home[r["path"]], Layout(f"json_{r['shape']}", "", r["encoding"])), []).append(r["path"])

    for path in kinds.get("xml", []):
        groups.setdefault((home[path], Layout("xml")), []).append(path)

    for (dataset, layout), paths in groups.items():
        try:
            yield _load_group(spark, dataset, layout, paths, documents, cfg)
        except Exception as e:  # one layout's failure leaves the others alone
            yield Loaded(dataset, layout, [], None, {p: f"{type(e).__name__}: {e}" for p in paths})
    sheets: dict[str, list[str]] = {}
    for path in kinds.get("excel", []):
        if path.lower().endswith(".xls"):
            failed[path] = "the legacy .xls format is not read"
        else:
            sheets.setdefault(home[path], []).append(path)
    for dataset, paths in sheets.items():
        for header, members, rows, errors in read_excel(spark, paths):
            typed = None if rows is None else with_reader_types(rows, cfg)
            yield Loaded(dataset, Layout("excel", "", "", header), [] if errors else members, typed, errors, True)
    if failed:
        for dataset in sorted({home[p] for p in failed}):
            yield Loaded(dataset, Layout("none"), [], None, {p: m for p, m in failed.items() if home[p] == dataset})


def _load_group(
    spark: SparkSession, dataset: str, layout: Layout, paths: list[str], documents: DataFrame | None, cfg: QualityConfig
) -> Loaded:
    if layout.kind == "csv":
        rows = with_reader_types(read_delimited(spark, paths, layout, cfg), cfg)
        return Loaded(dataset, layout, paths, rows, trimmed=True)
    if layout.kind == "xml":
        return Loaded(dataset, layout, paths, read_xml(spark, paths, cfg.xml_row_tag))
    if layout.kind == "lines":
        return Loaded(dataset, layout, paths, read_plain_text(spark, paths), trimmed=True)
    shape = layout.kind.removeprefix("json_")
    mine = documents.where((F.col("dataset") == dataset) & (F.col("encoding") == layout.encoding) & (F.col("shape") == shape))
    if shape == "objects":
        rows, broken = read_json(mine)
        bad = {r["path"]: "invalid JSON" for r in broken.collect()}
        return Loaded(dataset, layout, [p for p in paths if p not in bad], rows, bad)
    rows = read_json_values(mine)
    nulls = rows.where(F.col("data").isNull()).select(PATH).distinct()
    bad = {r[PATH]: "invalid JSON" for r in nulls.collect()}
    good = [p for p in paths if p not in bad]
    kept = infer_reader_types(rows.join(nulls, PATH, "left_anti") if bad else rows, cfg, ["data"]) if good else None
    return Loaded(dataset, layout, good, None if kept is None else kept.select("data", PATH), bad)
