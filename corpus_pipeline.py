"""The corpus pipeline: documents to token digests, in five stages.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next one's ``docs``.  All but the last keep the columns of
``documents``.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tableward.llm import hostrules, jaccard, mixing, recipes
from tableward.llm.common import documents
from tableward.llm.queries import token_digests
from tableward.session import owner, release, stage as written


def own_tables(stage):
    """Tables that a stage writes for itself are deleted when the next begins: its result is written by then."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, "corpus pipeline")
        with owner("corpus pipeline"):
            return stage(spark, docs, sf_dir)

    return run_stage


@own_tables
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's verdict reject go."""
    return hostrules.accepted(docs)


@own_tables
def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays."""
    return recipes.without_duplicates(docs)


@own_tables
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of a group of texts with 0.8 of their five-word shingles in common the one with the smallest id stays.

    Operator 8's fingerprints of five-word shingles and its covering masks link all texts, and every link is held
    against the exact similarity; an exact join adds what these miss.
    """
    return jaccard.representatives(docs)


@own_tables
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated to meet the sources' target weights."""
    return mixing.mixed(docs)


@own_tables
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded texts."""
    return token_digests(docs)


STAGES = [
    ("quality rules", quality_rules), ("exact dedup", exact_dedup), ("near dedup", near_dedup), ("source mix", source_mix),
    ("byte-level BPE", encoding),
]

#: Fingerprints and tokens can't be had in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what lies between them is written to the shared folder, and goes once it has been read.

    The result is a stage table too, which ``session.release`` deletes.
    """
    docs, read = documents(spark, sf_dir), None
    for _, stage in STAGES:
        own = f"corpus pipeline {uuid.uuid4().hex}"
        found = stage(spark, docs, sf_dir)
        with owner(own):
            docs = written(found, "pipeline")
        if read:
            release(spark, read)
        read = own
    release(spark, "corpus pipeline")
    return docs
