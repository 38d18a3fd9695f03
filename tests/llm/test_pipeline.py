"""The corpus pipeline against a plain version of its five stages."""

import os

import corpus_pipeline
from tableward import session
from tableward.llm.queries import OP4_SQL
from tests.compare import TESTDATA, connection
from tests.llm import brute
from tests.llm.test_jaccard import groups
from tests.llm.test_operators import bag

SF = f"{TESTDATA}/sf0.001"


def plain(sf_dir):
    con = connection(sf_dir)
    good = {d for d, keep in con.execute(f"SELECT doc_id, kept FROM ({OP4_SQL})").fetchall() if keep}
    rows = [r for r in con.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall() if r[0] in good]
    last = {text: d for d, text, _ in rows}  # the largest id of a text stays
    rows = [r for r in rows if last[r[1]] == r[0]]
    roots = groups([t for _, t, _ in rows])
    rows = [r for i, r in enumerate(rows) if roots[i] == i]  # the smallest id of a group stays
    known, out = brute.tokenizer(), []
    for (d, text, _), (*_, copies) in zip(rows, brute.mix(rows)):
        ids = known.encode_ordinary(text)
        out += [(d, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(text))] * copies
    return out


def test_run_equals_plain_stages(spark):
    folder = os.path.join(session.checkpoint_root(spark), "tableward")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = corpus_pipeline.run(spark, SF)
    assert bag(found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()) == bag(plain(SF))
    assert len(set(os.listdir(folder)) - before) == 1  # the result


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
