"""Versions of a table, written beside each other; a reader sees one of them whole.

Below a table's path each version has a folder of its own.  Only when all of it is written
an empty file in ``_commits`` names it: creating that file is one step of the file system,
so there is no moment at which half a version is current.  Its name begins with a number
one higher than the last one's; of writers at the same time the last to commit wins.  A
reader looks up the current folder once and stays with it.  The versions before the last
``keep`` are deleted with the next commit, and so is, after a day, what a writer that failed
has left.  A path without commits is a table written in place.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

COMMITS, VERSION = "_commits", "version-"
#: Versions kept, the current one included; hours after which a folder no commit names is a failed writer's.
KEEP, STALE_HOURS = 2, 24


def _files(spark: SparkSession, path: str):
    """The file system of a path, and a maker of paths."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def _listed(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Names and times (ms) in a folder, none where there is no folder."""
    fs, make = _files(spark, path)
    return sorted((s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(make(path))) if fs.exists(make(path)) else []


def versions(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Numbers and folders of the committed versions, the current one last."""
    split = [name.split("-", 1) for name, _ in _listed(spark, f"{path}/{COMMITS}") if name[0] not in "._"]
    return [(int(number), f"{path}/{VERSION}{own}") for number, own in split]


def current(spark: SparkSession, path: str) -> str:
    """The folder to read."""
    known = versions(spark, path)
    return known[-1][1] if known else path


def publish(df: DataFrame, path: str, form: str = "parquet", keep: int = KEEP) -> str:
    """Writes ``df`` as the next version of the table at ``path``; returns the version's folder.

    ``df`` may read the current version.  If the write fails, the current version stays.
    """
    spark, own = df.sparkSession, uuid.uuid4().hex
    folder = f"{path}/{VERSION}{own}"
    df.write.format(form).save(folder)
    known = versions(spark, path)
    fs, make = _files(spark, path)
    fs.create(make(f"{path}/{COMMITS}/{(known[-1][0] if known else 0) + 1:012d}-{own}"), False).close()
    expire(spark, path, keep)
    return folder


def expire(spark: SparkSession, path: str, keep: int = KEEP, stale_hours: float = STALE_HOURS) -> list[str]:
    """Deletes all but the last ``keep`` versions, and old folders that no commit names; returns what went."""
    known = versions(spark, path)
    fs, make = _files(spark, path)
    gone = known[: -max(keep, 1)]
    for number, folder in gone:  # the commit first: what is listed is whole
        fs.delete(make(f"{path}/{COMMITS}/{number:012d}-{folder.rsplit(VERSION, 1)[1]}"), False)
        fs.delete(make(folder), True)
    named = {folder for _, folder in known}
    before = (time.time() - 3600 * stale_hours) * 1000
    left = [f"{path}/{n}" for n, at in _listed(spark, path) if n.startswith(VERSION) and at < before and f"{path}/{n}" not in named]
    for folder in left:
        fs.delete(make(folder), True)
    return [folder for _, folder in gone] + left
