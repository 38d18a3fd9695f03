"""Near copies by exact five-word Jaccard similarity against all pairs."""

import random

import numpy as np
import pytest

import corpus_pipeline
from tableward.llm import jaccard, simhash
from tests.compare import TESTDATA
from tests.llm.test_operators import SCHEMA, bag, odd_rows

SF = f"{TESTDATA}/sf0.001"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))}


def groups(texts):
    """For each text the smallest index reachable by pairs of similarity 0.8 or more."""
    sets, root = [shingles(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def copies():
    """Texts at every similarity around 0.8, chains, a large group, and one passage in many otherwise different texts."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    prose = lambda n: [word() for _ in range(n)]
    texts = []
    for _ in range(60):
        words = prose(rng.randrange(12, 150))
        for _ in range(3):
            texts.append(" ".join(words))
            for _ in range(rng.randrange(1, 4)):
                words = list(words)
                words[rng.randrange(len(words))] = word()
    base = prose(100)
    for _ in range(60):
        words = list(base)
        words[rng.randrange(100)] = word()
        texts.append(" ".join(words))
    passage = prose(90)
    texts += [" ".join(passage + prose(rng.randrange(8, 30))) for _ in range(60)]
    return texts + ["", None, " ", "one two", "One  TWO", "one two three"]


@pytest.mark.parametrize("rounds", [0, 1, 2])
def test_groups_equal_all_pairs(spark, monkeypatch, rounds):
    monkeypatch.setattr(jaccard, "ROUNDS", rounds)
    texts = copies()
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3).cache()
    found = dict(map(tuple, jaccard.classes(frame).collect()))
    assert [found.get(i, i) for i in range(len(texts))] == groups(texts)


def test_pairs_just_at_the_similarity(spark):
    """Sets of 9 and 10 with 8 or 9 in common, and of 20 with 17 or 18: 8 of 10 is near enough, 17 of 23 is not."""
    texts, word = [], "{}{:03d}".format
    for k, (n, last) in enumerate([(14, 1), (14, 2), (24, 1), (24, 2), (24, 3), (64, 3), (64, 6), (64, 7), (64, 8)]):
        base = [word(chr(97 + k), i) for i in range(n)]
        texts += [" ".join(base), " ".join(base[:-last] + ["x" + w for w in base[-last:]]), " ".join(base[: n - last])]
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(2)
    found = dict(map(tuple, jaccard.classes(frame).collect()))
    assert [found.get(i, i) for i in range(len(texts))] == groups(texts)


def test_representatives_on_odd_rows(spark):
    rows = odd_rows()
    odd = spark.createDataFrame([(*r, 1, 7, 8, "f", "i", 9, "v", "k", 3) for r in rows], SCHEMA).repartition(3).cache()
    left = jaccard.representatives(odd)
    assert left.columns == odd.columns and left.count() == len(set(groups([t for _, t, *_ in rows])))
    assert jaccard.representatives(odd.limit(0)).count() == 0


def test_pipeline_stage_drops_every_near_copy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = {rows[g][0] for g in groups([t for _, t in rows])}
    assert bag(corpus_pipeline.near_dedup(spark, docs, SF).select("doc_id").collect()) == bag([(d,) for d in want])


def test_parities_differ_no_more_than_the_sets(spark):
    rng = np.random.default_rng(3)
    for n, other in [(1, 0), (40, 3), (300, 60), (2000, 900)]:
        whole = np.unique(rng.integers(0, 2**63, n + other, np.int64)).view(np.uint64)
        marks = [np.unpackbits(jaccard.parities(s).view(np.uint8)) for s in (whole, whole[other:])]
        assert len(marks[0]) == jaccard.MARKS and (marks[0] != marks[1]).sum() <= other


def test_fingerprints_of_five_words_propose(spark):
    """Equal fingerprints, and those within two bits, are proposed by covering masks; each text once."""
    frame = spark.createDataFrame([(5, 0), (3, 0), (9, 3), (2, 0b11111), (4, -1)], "row long, fp long")
    assert {tuple(sorted(p)) for p in map(tuple, jaccard.linked(frame).collect())} == {(3, 5), (3, 9)}
    text = " ".join("abcdefghij")
    (made,) = jaccard.sets(*[spark.createDataFrame([(1, text)], "row long, text string").select(*c) for c in (("row", "text"), ("row",))]).collect()
    assert made.fp == simhash.fingerprint_of(text, 5) != simhash.fingerprint_of(text)


def test_a_large_group_leaves_few_pairs_to_compare(spark, monkeypatch):
    """120 texts, each with some words of one base text replaced, are less alike to each other than to the base."""
    rng, texts = random.Random(4), []
    base = [f"w{i}" for i in range(200)]
    for _ in range(120):
        words = list(base)
        for at in rng.sample(range(200), 3):
            words[at] = f"x{rng.random()}"
        texts.append(" ".join(words))
    texts.append(" ".join(base))  # neither the first nor the smallest
    counts = []
    monkeypatch.setattr(jaccard, "confirmed", lambda c, found, of=jaccard.confirmed: counts.append(c.count()) or of(c, found))
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    found = dict(map(tuple, jaccard.classes(frame).collect()))
    assert [found.get(i, i) for i in range(len(texts))] == groups(texts)
    assert max(counts) <= 4 * len(texts)


def test_every_text_goes_through_the_masks(spark, monkeypatch):
    """Also texts that the set join would leave out at once."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.random()}" for _ in range(rng.randrange(3, 60))) for _ in range(30)] + ["", None, "one two"]
    texts.append(texts[0] + " more")
    seen = []
    monkeypatch.setattr(simhash, "links", lambda prints, of=simhash.links: seen.extend(r.fp for r in prints.collect()) or of(prints))
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    found = dict(map(tuple, jaccard.classes(frame).collect()))
    assert [found.get(i, i) for i in range(len(texts))] == groups(texts)
    assert sorted(seen) == sorted({simhash.fingerprint_of(t, 5) for t in texts})


def test_every_link_of_the_masks_is_compared(spark, monkeypatch):
    """Fingerprints ruled by a phrase that all texts repeat link more unlike texts than alike ones; the set join is left out."""
    rng, texts, prints = random.Random(6), [], set()
    word = lambda: f"x{rng.randrange(10**9)}"
    phrase = " ".join(word() for _ in range(7))
    for _ in range(15):
        tail = [word() for _ in range(20)]
        for times, last in [(7, 0), (8, 0), (7, 1), (7, 2), (8, 1)]:  # 7 and 8 times give the same set
            text = " ".join([phrase] * times + tail[: 20 - last] + [word() for _ in range(last)])
            if (made := simhash.fingerprint_of(text, 5)) not in prints:
                prints.add(made)
                texts.append(text)
    fps, root = [simhash.fingerprint_of(t, 5) for t in texts], list(range(len(texts)))
    linked = 0
    for i, a in enumerate(texts):
        for j in range(i):
            s, t = shingles(a), shingles(texts[j])
            near = ((fps[i] ^ fps[j]) % 2**64).bit_count() <= simhash.RADIUS
            linked += near
            if root[i] != root[j] and (s == t or near and 5 * len(s & t) >= 4 * len(s | t)):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    nothing = spark.createDataFrame([], "u long, v long")
    monkeypatch.setattr(jaccard, "proposals", lambda rows: nothing)
    monkeypatch.setattr(jaccard, "pairs", lambda rows: nothing)
    frame = spark.createDataFrame(list(enumerate(texts)), "row long, text string").repartition(3)
    found = dict(map(tuple, jaccard.classes(frame).collect()))
    assert linked > len(texts) > len(set(root))
    assert [found.get(i, i) for i in range(len(texts))] == root
