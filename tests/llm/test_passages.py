"""Shared passages against word windows, and fingerprints that no prepared strings can make equal."""

import random

import numpy as np

from tidewatch.llm import passages, suffix_dedup


def test_gram_hashes_tell_grams_apart():
    draw = np.random.default_rng(1)
    words = draw.integers(0, 3, 400).astype(np.uint64)
    for size in (1, 2, 5, 36):
        grams = passages.gram_hashes(words, size)
        assert len(grams) == 400 - size + 1
        seen = {}
        for i, g in enumerate(grams.tolist()):
            assert seen.setdefault(g, tuple(words[i : i + size])) == tuple(words[i : i + size])
        assert len(seen) == len({tuple(words[i : i + size]) for i in range(len(grams))})
    assert len(passages.gram_hashes(words[:10], 36)) == 0


def test_every_passage_of_fifty_words_is_found(spark, nothing):
    rng = random.Random(3)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    common = fresh(50)
    rows = [(i, " ".join(fresh(rng.randrange(0, 200)) + common + fresh(rng.randrange(0, 200)))) for i in range(30)]
    rows += [(100 + i, " ".join(fresh(300))) for i in range(30)]
    short = common[:35]
    rows += [(200 + i, " ".join(fresh(40) + short + fresh(40))) for i in range(5)] + [(300, None), (301, ""), (None, " ".join(common)), (302, rows[0][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r._id for r in passages.shared(docs).collect()}
    assert found == {*range(30), -(2**63), 302}
    assert passages.shared(nothing).count() == 0


def thue_morse(n):
    return np.array([bin(i).count("1") % 2 for i in range(n)], np.uint8) + 97


def test_prepared_strings_have_different_fingerprints():
    """Strings that sums of powers modulo 2**64 cannot tell apart, for any base."""
    a = thue_morse(1024)
    b = (195 - a).astype(np.uint8)
    for seed in range(20):
        at = np.array([0])
        for width in (256, 400, 1024):
            assert suffix_dedup.fingerprints(a, at, width, seed) != suffix_dedup.fingerprints(b, at, width, seed)
    both = np.concatenate([a, b, a])
    prints = suffix_dedup.fingerprints(both, np.array([0, 2048, 1024]), 400, 5)
    assert prints[0] == prints[1] != prints[2]
