"""Readers, manifest and sinks over folders written here."""

import io
import os
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tableward.config import QualityConfig
from tableward.registry import trips
from tableward.sources import manifest as Mf
from tableward.sources import readers as R
from tableward.sources import sinks as K
from tests.compare import TESTDATA, compare


def put(folder, name, content):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(content if isinstance(content, bytes) else content.encode())
    return path


def workbook(rows, date_style=False):
    def cell(ref, v):
        if v is None:
            return ""
        if isinstance(v, str):
            return f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>'
        if isinstance(v, bool):
            return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
        style = ' s="1"' if date_style and isinstance(v, float) else ""
        return f'<c r="{ref}"{style}><v>{v}</v></c>'

    body = "".join(
        f'<row r="{i + 1}">' + "".join(cell(f"{chr(65 + j)}{i + 1}", v) for j, v in enumerate(row)) + "</row>"
        for i, row in enumerate(rows)
    )
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="a" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId7" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData>{body}</sheetData></worksheet>')
    return out.getvalue()


@pytest.fixture()
def store(tmp_path):
    put(tmp_path, "sales/jan.csv", "Id,Price ($),Note\n1,2.5,x\n2,,\"a, b\"\n")
    put(tmp_path, "sales/feb.csv", "Id,Price ($),Note\n3,4.5,NaN\n")
    put(tmp_path, "cafe.csv", "name,n\ncaf\xe9,1\n".encode("latin-1"))
    put(tmp_path, "wide.csv", "a,b\n1,2,3\n")
    put(tmp_path, "empty.csv", "\n \n")
    put(tmp_path, "quoted.csv", 'a,b\n1,"two\nlines"\n2,z\n')
    put(tmp_path, "list.json", '[{"a":1,"b":{"c":2}},{"a":2}]')
    put(tmp_path, "one.json", ' {"a":1}')
    put(tmp_path, "bare.json", "42")
    put(tmp_path, "bares.json", '[1,\n "x"]')
    put(tmp_path, "pretty.json", '[\n  {\n    "a": 5\n  }\n]\n')
    put(tmp_path, "broken.json", '{"a":')
    put(tmp_path, "lines.json", '{"a":1}\n{"a":2}\n')
    put(tmp_path, "semi.txt", "a;b\n1;x\n2;y\n")
    put(tmp_path, "tab.txt", "a\tb\n1\tx\n")
    put(tmp_path, "pipe.dat", "a|b;c\n1|2;3\n")
    put(tmp_path, "plain.txt", "\n  hello\n\nworld; no\n\n".replace("world; no", "world"))
    put(tmp_path, "odd name [1] +%.csv", "a\n1\n")
    put(tmp_path, "book.xlsx", workbook([["k", "when", "ok"], ["x", 45292.5, True], ["y", None, False]], date_style=True))
    put(tmp_path, "bad.xlsx", b"not a zip")
    put(tmp_path, "old.xls", b"\xd0\xcf")
    return str(tmp_path)


def test_manifest(spark, store):
    files = Mf.list_files(spark, store).cache()
    assert files.count() == 21
    jan = Mf.file_metadata(files, "sales/jan.csv").first()
    assert (jan["content_type"], jan["kind"], jan["dataset"]) == ("text/csv", "csv", "sales")
    assert jan["size"] == os.path.getsize(f"{store}/sales/jan.csv")
    assert Mf.file_exists(files, "cafe.csv") and not Mf.file_exists(files, "nope.csv")
    assert [r["container"] for r in Mf.list_containers(files).collect()] == ["sales"]
    assert Mf.list_files(spark, store, prefix="sales/").count() == 2
    stats = Mf.container_stats(files).first()
    assert stats["object_count"] == 21 and stats["total_size_mb"] == round(stats["total_size_bytes"] / 1048576, 2)
    assert Mf.newest_first(files).count() == 21
    etag = Mf.read_content(spark, store, "cafe.csv").first()["etag"]
    assert len(etag) == 32


def test_file_age(spark, store):
    files = Mf.list_files(spark, store)
    assert Mf.newer_than(files, "2100-01-01 00:00:00").count() == 0
    assert Mf.newer_than(files, "2000-01-01 00:00:00").count() == 21


def test_size_guard(spark, store):
    files = Mf.list_files(spark, store)
    kept, refused = Mf.split_by_size(files, QualityConfig(max_file_bytes=20))
    names = {r["name"] for r in refused.collect()}
    assert "list.json" in names and "bare.json" not in names and "sales/jan.csv" not in names
    assert "exceeds maximum size limit of 20 bytes" in refused.first()["error_message"]
    assert kept.count() + len(names) == 21


def test_load_everything(spark, store):
    parts = list(R.load(spark, Mf.list_files(spark, store)))
    base = Mf.qualified(spark, store)
    rows, errors = {}, {}
    for p in parts:
        errors |= {k[len(base) + 1 :]: v for k, v in p.errors.items()}
        if p.rows is not None and p.paths:
            for r in p.rows.collect():
                d = r.asDict()
                rows.setdefault(d.pop(R.PATH)[len(base) + 1 :], []).append(d)
    assert set(errors) == {"wide.csv", "empty.csv", "broken.json", "lines.json", "bad.xlsx", "old.xls"}
    assert rows["sales/jan.csv"] == [
        {"Id": 1, "Price ($)": 2.5, "Note": "x"}, {"Id": 2, "Price ($)": None, "Note": "a, b"},
    ]
    assert rows["sales/feb.csv"] == [{"Id": 3, "Price ($)": 4.5, "Note": None}]
    assert rows["cafe.csv"] == [{"name": "café", "n": 1}]
    assert rows["quoted.csv"] == [{"a": 1, "b": "two\nlines"}, {"a": 2, "b": "z"}]
    assert sorted(r["a"] for r in rows["list.json"]) == [1, 2]
    assert {r["b_c"] for r in rows["list.json"]} == {2, None}
    assert rows["one.json"][0]["a"] == 1
    assert rows["pretty.json"][0]["a"] == 5
    assert rows["bare.json"] == [{"data": 42}]
    assert sorted(r["data"] for r in rows["bares.json"]) == ["1", "x"]
    assert rows["semi.txt"] == [{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]
    assert rows["tab.txt"] == [{"a": 1, "b": "x"}]
    assert sorted((r["line_number"], r["text_content"]) for r in rows["plain.txt"]) == [(1, "hello"), (2, ""), (3, "world")]
    assert rows["odd name [1] +%.csv"] == [{"a": 1}]
    assert sorted((r["k"], str(r["when"]), r["ok"]) for r in rows["book.xlsx"]) == [
        ("x", "2024-01-01 12:00:00", True), ("y", "None", False),
    ]
    assert rows["pipe.dat"] == [{"a|b": "1|2", "c": 3}]


def test_plain_text_numbers_over_splits(spark, tmp_path):
    lines = [f"line {i}" for i in range(5000)]
    path = put(tmp_path, "big.txt", "\n".join(lines))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        df = R.read_plain_text(spark, [path])
        got = {r["line_number"]: r["text_content"] for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {i + 1: t for i, t in enumerate(lines)}


def test_decode(spark):
    df = spark.createDataFrame([(bytearray(b"caf\xe9"),), (bytearray("café".encode()),)], "b binary")
    assert [r["t"] for r in df.select(R.decode_with_fallback(F.col("b")).alias("t")).collect()] == ["café", "café"]


def test_header_names():
    assert R.header_names('a,a,"b,c",', ",") == ["a", "a_1", "b,c", "Unnamed: 3"]


def test_xml(spark, tmp_path):
    path = put(tmp_path, "r.xml", "<rows><row><a>1</a><b>x</b></row><row><a>2</a></row></rows>")
    got = R.read_xml(spark, [path], "row").orderBy("a").collect()
    assert [(r["a"], r["b"]) for r in got] == [(1, "x"), (2, None)]


def test_sinks(spark, tmp_path):
    root = str(tmp_path)
    df = spark.sql("SELECT 1 AS a, 'x' AS b, array(1) AS l, NULL AS v, 'f' AS source_file, TIMESTAMP_NTZ '2024-01-01' AS ingested_at")
    K.write_raw(df, root, "d")
    assert K.read_raw(spark, root, "d").first()["a"] == 1
    # the file comes again with other columns: the later version wins
    later = spark.sql("SELECT 'z' AS a, 'f' AS source_file, TIMESTAMP_NTZ '2024-01-02' AS ingested_at")
    K.write_raw(later, root, "d")
    assert [r["a"] for r in K.read_raw(spark, root, "d").collect()] == ["z"]
    K.export_csv(df, f"{root}/export")
    back = K.read_cleaned_csv(spark, f"{root}/export").first()
    assert back["a"] == 1 and back["l"] == "[1]" and back["ingested_at"] == datetime(2024, 1, 1)
    K.write_cleaned(df, root, "d")
    assert K.read_cleaned(spark, root, "d").count() == 1
    summary = Mf.catalogue_summary(spark, f"{root}/cleaned").first()
    assert (summary["total_files"], summary["total_rows"]) == (1, 1)
    assert K.export_name(datetime(2024, 1, 2, 3, 4, 5)) == "data_export_20240102_030405.csv"


def test_many_json_files_are_read_by_folder_and_once(spark, tmp_path, monkeypatch):
    for i in range(40):
        put(tmp_path, f"{i}.json", f'[{{"a": {i},\n "b": "x {i}"}}, {{"a": null}}]' if i % 2 else f'{{"a": {i}}}')
    files = Mf.list_files(spark, str(tmp_path)).withColumn("dataset", F.lit("d"))
    paths = [r["path"] for r in files.select("path").collect()]
    assert R.located(spark, paths) == ["file:" + str(tmp_path)]
    assert sorted(R.located(spark, paths[1:])) == sorted(paths[1:])
    read = []
    monkeypatch.setattr(R, "json_documents", lambda s, p, of=R.json_documents: read.append(len(p)) or of(s, p))
    (part,) = R.load(spark, files)
    assert not part.errors and read == [40]
    assert sorted(r["a"] for r in part.rows.collect() if r["a"] is not None) == list(range(40)) and part.rows.count() == 60


def test_sniff_sorts_no_lines(spark, tmp_path, capsys):
    path = put(tmp_path, "a.csv", "\n a,b \n" + "1,2\n" * 50)
    R.sniff(spark, [path]).explain()
    assert "ObjectHashAggregate" in (plan := capsys.readouterr().out) and "Sort" not in plan
    assert R.sniff(spark, [path]).select("encoding", "header", "csv_fits").first() == ("UTF-8", " a,b ", True)


def test_files_of_clashing_headers_follow_the_rows(spark, monkeypatch):
    run, sql = trips._REGISTRY["csv_header_clash"]
    sf_dir = f"{TESTDATA}/sf0.001"
    monkeypatch.setattr(trips, "_LINES", 10)
    rows, made = spark.read.parquet(f"{sf_dir}/orders.parquet").count(), []
    monkeypatch.setattr(trips, "place", lambda s, label, of=trips.place: made.append(of(s, label)) or made[-1])
    problems, _ = compare(spark, sf_dir, run, sql)
    assert not problems and len(Mf.list_files(spark, made[0]).collect()) == rows // 10 + 4
