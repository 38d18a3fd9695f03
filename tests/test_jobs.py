"""Ingest and clean cycles, batch and streaming."""

import os
import time

from pyspark.sql import functions as F

from tableward import session
from tableward.operators import status as St
from tableward.sources import sinks as K
from tableward.streaming import jobs as J
from tests.test_sources import put


def log_of(spark, root):
    return J.read_log(spark, root, "file_status", St.FILE_STATUS)


def latest(spark, root, stage):
    rows = St.latest_per_key(log_of(spark, root).where(F.col("stage") == stage), ["file"]).collect()
    return {r["file"]: r["status"] for r in rows}


def test_cycles(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "lake")
    put(src, "sales/a.csv", "Id,Amount\n1,10\n2,N/A\n2,N/A\n3,30\n")
    put(src, "sales/b.csv", "Id,Amount\n7,70\n")
    put(src, "bad.csv", "a,b\n1,2,3\n")
    assert J.run_ingest(spark, src, root, now="2024-01-01 00:00:00") == {"ingested": 2, "error": 1}
    assert latest(spark, root, "ingest") == {"sales/a.csv": "ingested", "sales/b.csv": "ingested", "bad.csv": "error"}
    raw = K.read_raw(spark, root, "sales")
    assert raw.count() == 5 and {"id", "amount", "ingested_at", "data_source", "source_file"} == set(raw.columns)

    assert J.run_clean(spark, root, now="2024-01-01 01:00:00") == {"sales": "completed"}
    cleaned = K.read_cleaned(spark, root, "sales")
    assert sorted((r["id"], r["amount"]) for r in cleaned.collect()) == [(1, 10.0), (2, 30.0), (3, 30.0), (7, 62.5)]
    summary = K.read_summary(spark, root, "sales").first()
    assert (summary["original_rows"], summary["cleaned_rows"]) == (5, 4)
    assert summary["quality_report"]["uniqueness"]["threshold_met"] is False
    assert J.run_clean(spark, root, now="2024-01-01 02:00:00") == {}

    # unchanged files are skipped, the failed one is tried again, a changed one is replaced
    assert J.run_ingest(spark, src, root, now="2024-01-02 00:00:00") == {"ingested": 0, "error": 1}
    time.sleep(0.01)
    put(src, "sales/b.csv", "Id,Amount\n8,80\n9,90\n")
    os.utime(f"{src}/sales/b.csv", (2_000_000_000, 2_000_000_000))
    put(src, "bad.csv", "a,b\n1,2\n")
    assert J.run_ingest(spark, src, root, now="2024-01-03 00:00:00") == {"ingested": 2, "error": 0}
    assert sorted(r["id"] for r in K.read_raw(spark, root, "sales").collect()) == [1, 2, 2, 3, 8, 9]
    assert J.run_clean(spark, root, now="2024-01-03 01:00:00") == {"bad": "completed", "sales": "completed"}
    cycle = J.read_log(spark, root, "cycle_status", St.CYCLE_STATUS)
    assert St.pipeline_status(cycle).first()["overall"] == "healthy"
    assert [r["event"] for r in St.timeline(log_of(spark, root)).collect()] == ["Cleaned bad", "Cleaned sales"]


def test_stream_equals_batch(spark, tmp_path):
    src, batch, live = str(tmp_path / "src"), str(tmp_path / "batch"), str(tmp_path / "live")
    for i in range(3):
        put(src, f"d/{i}.csv", "k,v\n" + "".join(f"{i * 10 + j},x{j}\n" for j in range(10)))
    J.run_ingest(spark, src, batch, now="2024-01-01 00:00:00")
    J.stream_ingest(spark, src, live, str(tmp_path / "cp"), now="2024-01-01 00:00:00", max_files=1).awaitTermination()
    rows = [sorted((r["k"], r["v"], r["source_file"]) for r in K.read_raw(spark, p, "d").collect()) for p in (batch, live)]
    assert rows[0] == rows[1] and len(rows[0]) == 30
    put(src, "d/3.csv", "k,v\n99,y\n")
    J.stream_ingest(spark, src, live, str(tmp_path / "cp"), now="2024-01-01 00:00:00").awaitTermination()
    assert K.read_raw(spark, live, "d").count() == 31


def test_failed_clean_is_isolated(spark, tmp_path, monkeypatch):
    src, root = str(tmp_path / "src"), str(tmp_path / "lake")
    put(src, "a.csv", "v\n1\n2\n")
    put(src, "b.csv", "v\n3\n4\n")
    J.run_ingest(spark, src, root, now="2024-01-01 00:00:00")
    real = J.clean

    def fails(df, *args, **kwargs):
        if df.where("source_file = 'a.csv'").count():
            raise RuntimeError("boom")
        return real(df, *args, **kwargs)

    monkeypatch.setattr(J, "clean", fails)
    assert J.run_clean(spark, root, now="2024-01-01 01:00:00") == {"a": "error", "b": "completed"}
    assert J.pending_datasets(spark, root).first()["file"] == "a"


def test_stage_tables_are_gone_after_the_cycles(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "lake")
    put(src, "a/1.csv", "k,v\n1,x\n1,x\n2,y\n")
    before = len(session._STAGED.get(spark.sparkContext.applicationId, []))
    J.run_ingest(spark, src, root, now="2024-01-01 00:00:00")
    J.run_clean(spark, root, now="2024-01-01 01:00:00")
    assert len(session._STAGED.get(spark.sparkContext.applicationId, [])) == before


def test_rows_written_during_a_clean_stay_pending(spark, tmp_path, monkeypatch):
    src, root = str(tmp_path / "src"), str(tmp_path / "lake")
    put(src, "a/1.csv", "k,v\n1,x\n")
    J.run_ingest(spark, src, root, now="2024-01-01 00:00:00")
    real = J.clean

    def slow(df, *args, **kwargs):
        put(src, "a/2.csv", "k,v\n2,y\n")
        monkeypatch.setattr(J, "clean", real)
        J.run_ingest(spark, src, root, now="2024-01-01 02:00:00")
        return real(df, *args, **kwargs)

    monkeypatch.setattr(J, "clean", slow)
    J.run_clean(spark, root, now="2024-01-01 03:00:00")
    assert [r["file"] for r in J.pending_datasets(spark, root).collect()] == ["a"]
    J.run_clean(spark, root, now="2024-01-01 04:00:00")
    assert J.pending_datasets(spark, root).isEmpty() and K.read_cleaned(spark, root, "a").count() == 2


def test_reruns_keep_the_same_rows(spark, tmp_path):
    src, kept = str(tmp_path / "src"), []
    for name in ("b", "a", "c"):
        put(src, f"d/{name}.csv", "k,v\n1,x\n2,y\n")
    for run in range(2):
        root = str(tmp_path / f"lake{run}")
        J.run_ingest(spark, src, root, now="2024-01-01 00:00:00")
        J.run_clean(spark, root, now="2024-01-01 01:00:00")
        kept.append(sorted((r["k"], r["source_file"]) for r in K.read_cleaned(spark, root, "d").collect()))
    assert kept[0] == kept[1] == [(1, "d/a.csv"), (2, "d/a.csv")]


def test_kinds_of_one_name_stay_apart(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "lake")
    put(src, "a.csv", "k\n1\n")
    put(src, "a.json", '[{"q": 5}]')
    assert J.run_ingest(spark, src, root, now="2024-01-01 00:00:00")["ingested"] == 2
    assert K.read_raw(spark, root, "a").first()["k"] == 1 and K.read_raw(spark, root, "a.json").first()["q"] == 5
