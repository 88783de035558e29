"""The pipeline against a plain version: SQL for the rules and the benchmark, brute force for copies, masks and ids."""

import zlib

import numpy as np
import pandas as pd

import brute
import corpus_pipeline
from oracle import connect
from tidewatch.llm import secrets, sql
from tidewatch.llm.queries import tokenizer
from tidewatch.llm.tokens import Encoder


def masked(text, net):
    parts, at = [], 0
    for start, _, end in secrets.all_spans([text], net)[0]:
        if start >= at:
            parts += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def test_pipeline_against_plain(spark, folder):
    con = connect(folder)
    good = con.execute(f"SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM ({sql.quality_sql('documents')}) WHERE kept)").fetchall()
    groups = brute.near_duplicates(good)
    first = pd.DataFrame([r for r in good if groups[r[0]][2]], columns=["doc_id", "text"])
    con.register("firsts", first)
    clean = con.execute(f"SELECT doc_id, text FROM firsts WHERE doc_id NOT IN (SELECT doc_id FROM ({sql.contamination_sql('firsts')}) WHERE contaminated)").fetchall()
    net = secrets.train(spark.createDataFrame(clean, "doc_id long, text string"))
    encoder = Encoder.of(tokenizer("byte_bpe_50k.json")).tokenizer
    want = {i: np.array(encoder.encode(masked(t, net), add_special_tokens=False).ids + [1], "<u4") for i, t in clean}

    pieces = {}
    for r in corpus_pipeline.run(spark, folder).collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(want)
    for i, ids in want.items():
        at = 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns, name


def test_masking_is_fitted_on_every_finding(spark, monkeypatch):
    """More findings than any bound of rows; all of them reach the networks' parts."""
    seen, plain = [], secrets.parts
    monkeypatch.setattr(secrets, "parts", lambda *a, **b: seen.append(plain(*a, **b)) or seen[-1])
    rng = np.random.default_rng(5)
    texts = [f"we saw {rng.bytes(10).hex()} there" for _ in range(5_200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    masked = corpus_pipeline.mask_secrets(spark, docs, "")
    assert {r.text for r in masked.collect()} == {"we saw [SECRET] there"}
    assert seen[0].filter("kind = 0 AND label = 1").select("frame").distinct().count() == 5_200


def test_masking_thresholds_count_every_finding(spark, monkeypatch):
    calls, plain = [], secrets.calibrated
    monkeypatch.setattr(secrets, "calibrated", lambda net, *counts: calls.append(counts) or plain(net, *counts))
    rng = np.random.default_rng(7)
    texts = [f"we saw {rng.bytes(10).hex()} there" for _ in range(1_000)]
    corpus_pipeline.mask_secrets(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "").collect()
    assert sum(int(counts[kinds == 0].sum()) for kinds, _, _, counts in calls[-2:]) == 1_000
