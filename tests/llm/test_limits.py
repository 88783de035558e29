"""Bounds that a hot key, a repeated row or a long text must not break; plain versions on whole tables."""

import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.llm import common, licenses, packing, quality_classifier, toxicity
from tidewatch.llm.queries import QUERIES, tokenizer
from tidewatch.llm.tokens import Encoder


def plain_places(words):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    return sorted((i, label) for i in range(len(words)) for p, label in phrases.items() if tuple(words[i : i + len(p)]) == p)


def words_of(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_licences_against_plain(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in QUERIES["op9_licenses"](spark, folder).collect()}
    for i, text in rows:
        words, r = words_of(text), got[i]
        places = plain_places(words)
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == ((places[0][0], places[-1][0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels


def test_licences_of_odd_places():
    text = "mit mit license general public license général public license MIT-License apache license apache"
    words, places, _, _ = licenses.scan_text(text)
    assert (words, sorted((w, label) for label, w in places)) == (len(words_of(text)), plain_places(words_of(text)))


def test_licence_work_grows_with_the_text():
    def seconds(n):
        begun = time.perf_counter()
        assert len(licenses.scan_text("mit license " * n)[1]) == n
        return time.perf_counter() - begun

    seconds(100)
    assert seconds(80_000) < 5


def test_packing_splits_repeated_rows_and_long_texts(spark):
    path = tokenizer("byte_bpe_50k.json")
    rows = [(7, "the same words again " * 30)] * 400 + [(8, "one very long text of many words " * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    packed = packing.pack(docs, path, 1, window=256, group_bytes=40_000).collect()
    groups = -(-sum(len(t) + 16 for _, t in rows) // 40_000)
    size = np.bincount([r.sequence_id % groups for r in packed], [r.length for r in packed], groups)
    assert size.max() < 2.5 * size.mean()
    by_sequence = {}
    for r in packed:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        ends = np.cumsum([0] + [n for _, n in sorted(pieces)])
        assert [o for o, _ in sorted(pieces)] == ends[:-1].tolist() and ends[-1] <= 256
    ids = Encoder.of(path).tokenizer.encode(rows[-1][1], add_special_tokens=False).ids + [1]
    long = sorted((r for r in packed if r.doc_id == 8), key=lambda r: r.start)
    assert np.concatenate([np.frombuffer(r.ids, "<u4") for r in long]).tolist() == ids
    assert sum(r.length for r in packed if r.doc_id == 7) == 400 * (len(Encoder.of(path).tokenizer.encode(rows[0][1], add_special_tokens=False).ids) + 1)


@pytest.mark.parametrize("name, file, end", [("op3_token_files", "word_bpe_49k.json", 2), ("op6_packing", "byte_bpe_50k.json", 1)])
def test_ids_against_the_library(spark, folder, name, file, end):
    library, want = Encoder.of(tokenizer(file)).tokenizer, {}
    at = 0
    for r in sorted(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()):
        want[r.doc_id] = at, np.array(library.encode(r.text or "", add_special_tokens=False).ids + [end], "<u4")
        at += len(want[r.doc_id][1])
    for r in QUERIES[name](spark, folder).collect():
        before, ids = want[r.doc_id]
        if name == "op3_token_files":
            assert (r.start, r.n_tokens, r.ids_crc32) == (before, len(ids), zlib.crc32(ids.tobytes()))
        else:
            assert (r.doc_tokens, r.ids_crc32) == (len(ids), zlib.crc32(ids[r.start : r.start + r.length].tobytes()))


def test_one_text_for_each_id_within_the_bound(spark):
    docs = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "x" * 1000), (3, None), (4, "y" * 1000), (None, "z")], "doc_id long, text string")
    ids = spark.createDataFrame([(1,), (2,), (2,), (3,), (4,), (9,)], "doc_id long")
    first = docs.where("doc_id = 1").orderBy(F.xxhash64("text")).first().text
    found = {r.doc_id: r.text for r in common.one_text_each(docs, ids, 10**6).collect()}
    assert found == {1: first, 2: "x" * 1000, 3: "", 4: "y" * 1000}
    assert len(common.one_text_each(docs, ids, 1200).collect()) == 3


@pytest.mark.parametrize("module, label", [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_repeated_rows_and_two_labels(spark, module, label):
    good, bad = "a fine and quiet sentence number ", "awful terrible nasty words "
    rows = [(i, (good if i % 2 else bad) + str(i)) for i in range(200)]
    marks = [(i, 1 - i % 2) for i in range(200)]
    docs, labels = (spark.createDataFrame(x, schema) for x, schema in ((rows, "doc_id long, text string"), (marks, f"doc_id long, {label} int")))
    # Rows written many times and labels written twice, once the other way: of two labels the smallest counts.
    twice = spark.createDataFrame(rows + [rows[0]] * 500, "doc_id long, text string")
    both = spark.createDataFrame(marks + marks + [(1, 1)], f"doc_id long, {label} int")
    one, other = (module.score(docs, module.train(d, m, label, F.lit(True))).collect() for d, m in ((docs, labels), (twice, both)))
    assert {r.doc_id: r.score for r in one} == {r.doc_id: r.score for r in other}
    assert np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 0) for r in one]) > 0.9
