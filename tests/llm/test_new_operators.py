"""Prefix counts, whitening and collocations against plain versions, and on odd rows."""

import math
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tableward.llm import charpoly, phrases, tokencounts, whitening
from tableward.llm.queries import QUERIES
from tests.compare import TESTDATA
from tests.llm import brute
from tests.llm.test_operators import SCHEMA, odd_rows

SF = f"{TESTDATA}/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def own():
    with open(MODEL, "rb") as file:
        return tokencounts.Pieces(file.read())


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, 7, 8, "f", "i", 9, "v", "k", 3) for r in odd_rows()], SCHEMA).repartition(3).cache()


# -- 11 ---------------------------------------------------------------------


def test_counts_of_every_prefix(own, library):
    rng = random.Random(1)
    parts = ["a", "b", "the", "ing", " ", "  ", " " * 19, "é", "日", "\n", "\t", "20", "▁", "\x00", "🙂", "<s>", "<0x0A>", "ĳ", "ﬁ", "Hello", " wor", ".", "tion", "ﷺ", "́"]
    for _ in range(300):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(30)))
        assert own.counts(text).tolist() == [len(library.encode(text[:i])) for i in range(len(text) + 1)]


def test_long_texts_are_walked_in_parts(own, library, monkeypatch):
    text = ("one two  three\n" * 50 + "x" * 5000 + " ") * 3
    want = own.counts(text)
    monkeypatch.setattr(tokencounts, "CHARACTERS", 100)
    monkeypatch.setattr(tokencounts, "STRETCHES", 7)
    monkeypatch.setattr(tokencounts, "CACHED", 20)
    monkeypatch.setattr(tokencounts, "PAIRS", 20)
    assert (own.counts(text) == want).all() and want[-1] == len(library.encode(text))


def test_token_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op11_prefix_counts"][0](spark, SF).collect()
    assert len(found) == len(texts)
    for r in found:
        text = texts[r.doc_id] or ""
        n = len(library.encode(text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 4096)
        assert len(library.encode(text[: r.n_chars_within])) <= 4096
        assert r.over_limit == (r.n_chars_within < len(text))


def test_budgets_on_odd_rows(odd, library):
    counts = F.col("tokens")
    found = tokencounts.prefix_counts(odd, MODEL, into="tokens")
    assert found.columns == [*odd.columns, "tokens"]
    got = found.select("text", "doc_id", tokencounts.total(counts).alias("n"), tokencounts.tokens_within(counts, F.lit(10)).alias("ten"),
                       tokencounts.truncated(F.col("text"), counts, 5).alias("cut"), tokencounts.characters_within(counts, 5).alias("chars")).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        text = r.text or ""
        sizes = [len(library.encode(text[:i])) for i in range(min(len(text), 200) + 1)]
        assert (r.n, r.ten) == (len(library.encode(text)), len(library.encode(text[:10])))
        assert r.chars == max(i for i, n in enumerate(sizes) if n <= 5)
        assert r.cut == (None if r.text is None else text[: r.chars])
    with pytest.raises(ValueError, match="column already"):
        tokencounts.prefix_counts(odd, MODEL, into="IDS")
    assert tokencounts.prefix_counts(odd.limit(0), MODEL).count() == 0


def test_only_models_that_can_be_counted(own):
    from sentencepiece import sentencepiece_model_pb2

    told = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        told.ParseFromString(file.read())
    told.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError, match="leave texts as they are"):
        tokencounts.Pieces(told.SerializeToString())


# -- 12 ---------------------------------------------------------------------


def exact(matrix):
    """The polynomial by Newton's sums, in fractions of whole numbers."""
    size = len(matrix)
    a, power, sums = np.array(matrix, object), np.array(matrix, object), []
    for _ in range(size):
        sums.append(sum(power[i, i] for i in range(size)))
        power = power @ a
    found = [1]
    for k in range(1, size + 1):
        found.append(-sum(found[k - 1 - i] * sums[i] for i in range(k)) // k)
    return found[::-1]


def test_characteristic_polynomials():
    rng = np.random.default_rng(4)
    for size in (1, 2, 3, 7, 12):
        for rank in {1, max(size // 2, 1), size}:
            rows = rng.integers(-9, 9, (rank, size)) * int(10 ** rng.integers(0, 6))
            matrix = (rows.T @ rows).tolist()
            trace = sum(matrix[i][i] for i in range(size))
            got = charpoly.combined((p, charpoly.polynomial_mod(matrix, p)) for p in charpoly.primes(charpoly.needed(trace, size)))
            assert got == exact(matrix)
            assert charpoly.Roots(got).positive == np.linalg.matrix_rank(np.array(matrix, float))


def test_equal_roots_get_vectors_at_right_angles():
    matrix = [[2, 1, 0, 0], [1, 2, 0, 0], [0, 0, 3, 0], [0, 0, 0, 0]]
    roots = charpoly.Roots(exact(matrix))
    for rank, want, before, times in ((1, 3, 0, 2), (2, 3, 0, 2), (3, 1, 2, 1)):
        low, bits, above, many = roots.bracket(rank)
        root, vectors = charpoly.eigenvectors(matrix, low, bits, many)
        assert (above, many) == (before, times) and float(root) == want
        assert np.allclose(vectors @ vectors.T, np.eye(times), atol=1e-15) and np.allclose(np.array(matrix) @ vectors.T, want * vectors.T, atol=1e-15)


def test_whitening_query(spark):
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = sorted(rows)
    n, deviations, _, explained, want = brute.whitened([rows[i] for i in ids])
    got = {(r.vec_id, r.component): r for r in QUERIES["op12_exact_whitening"][0](spark, SF).collect()}
    assert len(got) == 16 * len(ids)
    assert {r.n for r in got.values()} == {n} and len({r.identity_error for r in got.values()}) == 1
    assert next(iter(got.values())).identity_error < 1e-9
    for k in range(16):
        column = np.array([got[i, k + 1].whitened for i in ids])
        sign = np.sign(column @ want[:, k])
        assert np.allclose(sign * column, want[:, k], atol=1e-8)
        assert all(abs(got[i, k + 1].explained / explained[k] - 1) < 1e-9 for i in ids)
        assert [got[i, k + 1].deviation for i in ids] == deviations


def test_whitening_on_odd_rows(spark):
    rng = random.Random(2)
    plain = [[rng.gauss(0, 1) * s for s in (3.0, 1.0, 0.5, 0.0)] for _ in range(60)]
    rows = list(enumerate(plain)) + [(3, plain[3]), (None, plain[4]), (70, None), (71, [None, 1.0, 2.0, 3.0]), (72, [math.nan, 1.0, 2.0, 3.0]),
                                     (73, [math.inf, 1.0, 2.0, 3.0]), (74, []), (75, [1.0, 2.0]), (76, [1.0, 2.5]), (77, [9.0]), (78, [9.0])]
    frame = spark.createDataFrame([(*r, "w", 1) for r in rows], "vec_id long, embedding array<double>, whitening string, _x int").repartition(3)
    found = whitening.whiten(frame, "embedding")
    assert found.columns == [*frame.columns, "_whitening"]
    got = found.select("vec_id", "_whitening.*").collect()
    assert sorted((r.vec_id for r in got if r.vec_id is not None and r.vec_id >= 60)) == [74, 75, 76, 77, 78] and len(got) == 67
    n, deviations, _, explained, want = brute.whitened(plain, 3)
    by_id = {r.vec_id: r for r in got}
    for i in range(60):
        assert (by_id[i].n, by_id[i].deviation) == (60, deviations[i])
        assert np.allclose(np.abs(by_id[i].whitened), np.abs(want[i]), atol=1e-9) and np.allclose(by_id[i].explained, explained, rtol=1e-9)
    assert [list(by_id[i].whitened) for i in (75, 76)] == [[-1.0], [1.0]] and by_id[75].n == 2
    assert [by_id[i].whitened for i in (74, 77, 78)] == [[], [], []]
    long = whitening.components(frame, "vec_id", "embedding")
    assert long.count() == 62 * 3 + 2 and long.where("component > 3").count() == 0
    assert whitening.components(frame.limit(0), "vec_id", "embedding").count() == 0


def test_whitening_of_huge_entries(spark):
    rows = [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 5e9])]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "embedding").select("vec_id", "whitening.*").collect()
    assert [len(r.whitened) for r in got] == [2, 2, 2] and all(r.identity_error < 1e-4 for r in got)


# -- 13 ---------------------------------------------------------------------


@pytest.mark.parametrize("least, top", [(30, 2000), (2, 100), (1, 7)])
def test_collocations(spark, least, top):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.where(F.length("text") < 3000) if least == 1 else docs
    got = phrases.collocations(docs, least=least, top=top).collect()
    assert sorted(map(tuple, got)) == sorted(brute.collocations([(r.lang, r.text) for r in docs.collect()], least, top))


def test_collocations_on_odd_rows(odd):
    rows = [(lang, text) for _, text, lang, _ in odd_rows()]
    rows = rows + [("fr", "A b\tC. a  B c, a B! " + "é É " * 9 + "b" * 40), ("", "q q q q q q q")]
    more = odd.sparkSession.createDataFrame([(text, lang, 1, "x", 2) for lang, text in rows], "text string, lang string, phrase int, a string, _n int")
    assert sorted(map(tuple, phrases.collocations(more, least=2).collect())) == sorted(brute.collocations(rows, 2))
    assert phrases.collocations(more.limit(0)).count() == 0


def test_tries_burst_and_spill(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 4)
    monkeypatch.setattr(phrases, "ENTRIES", 200)
    monkeypatch.setattr(phrases, "NUMBERED", 300)
    monkeypatch.setattr(phrases, "BLOCK", 400)
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") * rng.choice((1, 1, 1, 9)) + (str(rng.randrange(90)) if rng.random() < 0.2 else "") for _ in range(n)) for n in (900, 3, 0, 50, 2500)]
    for words in (1, 2, 3, 4):
        counter, found = phrases.Counter(words, None), {}
        for batch in [*counter.count("en", [None, *texts]), *counter.count("fr", texts[:2]), *counter.emptied()]:
            for row in batch.to_pylist():
                key = row["lang"], row["phrase"]
                found[key] = found.get(key, 0) + row["f"]
        want = {}
        for lang, text in [("en", t) for t in texts] + [("fr", t) for t in texts[:2]]:
            split = text.split()
            for i in range(len(split) - words + 1):
                key = lang, " ".join(split[i : i + words])
                want[key] = want.get(key, 0) + 1
        assert found == want


def test_tries_take_few_bytes_a_phrase():
    import tracemalloc

    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 1000, 3000)) for _ in range(100)]
    counter = phrases.Counter(3, None)
    list(counter.count("en", ["w" + " w".join(map(str, range(1000)))]))
    tracemalloc.start()
    list(counter.count("en", texts))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert counter.entries() > 290_000 and held / counter.entries() < 90


def test_texts_without_blanks_are_read_in_parts(monkeypatch):
    monkeypatch.setattr(phrases, "BLOCK", 100)
    text = "\n".join(f"A{i}\tB{i}" for i in range(500))
    blocks = list(phrases._blocks([text, None, "x y"]))
    assert max(len(raw) for raw, _ in blocks) < 120 and [goes_on for _, goes_on in blocks[:2]] == [False, True]
    assert b"".join(raw for raw, _ in blocks).replace(b"\xff", b" ").split() == (text + " x y").lower().encode().split()
