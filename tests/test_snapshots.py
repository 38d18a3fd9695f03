"""Versions of a table: readers see one of them whole."""

import os

import pytest
from pyspark.sql import functions as F

from tableward.sources import sinks as K
from tableward.sources import snapshots as V


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "t")
    V.publish(spark.range(10), path)
    old = spark.read.parquet(V.current(spark, path))
    V.publish(spark.range(5), path)
    assert old.count() == 10 and spark.read.parquet(V.current(spark, path)).count() == 5


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    V.publish(spark.range(10), path)
    with pytest.raises(Exception, match="stopped"):
        V.publish(spark.range(100).withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("stopped"))).otherwise(1)), path)
    assert spark.read.parquet(V.current(spark, path)).count() == 10
    # what was written whole but not committed is not seen either
    spark.range(3).write.parquet(f"{path}/{V.VERSION}other")
    assert spark.read.parquet(V.current(spark, path)).count() == 10
    assert V.expire(spark, path) == []
    gone = V.expire(spark, path, stale_hours=-1)
    assert f"{path}/{V.VERSION}other" in gone and spark.read.parquet(V.current(spark, path)).count() == 10


def test_a_version_made_from_the_current_one(spark, tmp_path):
    path = str(tmp_path / "t")
    V.publish(spark.range(4), path)
    for _ in range(3):
        V.publish(spark.read.parquet(V.current(spark, path)).withColumn("id", F.col("id") + 1), path)
    assert sorted(r.id for r in spark.read.parquet(V.current(spark, path)).collect()) == [3, 4, 5, 6]
    assert [n for n, _ in V.versions(spark, path)] == [3, 4]
    assert len([n for n in os.listdir(path) if n.startswith(V.VERSION)]) == V.KEEP


def test_the_last_of_two_writers_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    first = V.publish(spark.range(1), path)
    own = first.rsplit(V.VERSION, 1)[1]
    spark.range(2).write.parquet(f"{path}/{V.VERSION}zz")  # a writer that saw no commit either
    open(f"{path}/{V.COMMITS}/000000000001-zz", "w").close()
    assert V.current(spark, path).endswith("zz") and own < "zz"
    V.publish(spark.range(3), path)
    assert spark.read.parquet(V.current(spark, path)).count() == 3


def test_tables_written_in_place_and_cleaned_tables(spark, tmp_path):
    root = str(tmp_path / "lake")
    spark.range(7).write.parquet(K.dataset_path(root, "cleaned", "d"))
    before = K.read_cleaned(spark, root, "d")
    assert before.count() == 7
    K.write_cleaned(before.where("id < 2"), root, "d")
    assert K.read_cleaned(spark, root, "d").count() == 2 and before.count() == 7
    K.write_summary(spark.range(1), root, "d")
    K.write_summary(spark.range(2), root, "d")
    assert K.read_summary(spark, root, "d").count() == 2
