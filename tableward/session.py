"""Session defaults and the shared staging area."""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STAGED: dict[str, list[tuple[str | None, str]]] = {}
_OWNER: ContextVar[str | None] = ContextVar("owner", default=None)


def build(app: str = "tableward", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.  A cluster sets its own master."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own;
    on a cluster a machine-local folder would not be seen by other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="tableward-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def place(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; it belongs to the current owner, and ``release`` deletes what is written there."""
    path = os.path.join(checkpoint_root(spark), "tableward", f"{label}-{uuid.uuid4().hex}")
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append((_OWNER.get(), path))
    return path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage after a shuffle that several passes build on.  Parquet
    rather than ``checkpoint()`` so that each later pass reads only the columns
    it needs; the files outlive any executor.
    """
    spark = df.sparkSession
    path = place(spark, label)
    fixed = df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, T.NullType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
    fixed.write.parquet(path)
    return spark.read.schema(fixed.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished jobs.

    Spark deletes them once the driver has collected the plans that own them, which can
    take long.  Between phases that each move much data, asking for it keeps the disk small.
    Asked twice, as the last job's plan is only let go of a moment after its end.
    """
    for _ in range(2):
        time.sleep(0.7)
        gc.collect()
        spark.sparkContext._jvm.System.gc()


@contextmanager
def owner(name: str) -> Iterator[str]:
    """Stage tables written inside belong to ``name``, so that ``release`` can delete just these."""
    token = _OWNER.set(name)
    try:
        yield name
    finally:
        _OWNER.reset(token)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes the stage tables written inside at the end: for jobs that have then written their results."""
    with owner(f"temporary-{uuid.uuid4().hex}") as name:
        try:
            yield
        finally:
            release(spark, name)


def release(spark: SparkSession, name: str | None = None) -> int:
    """Delete the stage tables this application wrote, or those of one owner; returns how many."""
    app = spark.sparkContext.applicationId
    known = _STAGED.pop(app, [])
    gone = [path for own, path in known if name is None or own == name]
    if left := [entry for entry in known if entry[1] not in set(gone)]:
        _STAGED[app] = left
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in gone:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(gone)
