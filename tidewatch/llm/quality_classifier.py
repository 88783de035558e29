"""Supervised subword embeddings for text quality.

A text is the average of learned vectors, and a softmax layer turns the average into class
probabilities. The vectors are hashed: one for each word, one for each pair of neighbouring words,
one for each character n-gram inside a word (UTF-8 bytes, n in `NGRAMS`), one shared by all pairs of equal
neighbours, and one that every text has, so that an empty text gets a score as well. Training is
plain stochastic gradient descent in numpy, one document at a step, with a falling rate.

Only `TRAIN_ROWS` labelled documents of each class are used, those with the smallest hashes of
their id; whole texts, never a prefix. Classes are drawn evenly, and the classes' true shares
among the allowed labels are put back into the last layer afterwards.

Since averaging and the last layer are linear, a fitted model is scored as one number for each
bucket: a table of `BUCKETS` floats (half a megabyte) that goes to the tasks with the code.

Null text counts as empty. Repeated rows are all returned. With labels of one class only, or
none, the score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import KEY, keyed, one_text_each, stored, text_array, text_bytes, text_chunks
from tidewatch.llm.shingles import EXACT, UNBROKEN, mix, word_hashes

BUCKETS = 1 << 17
NGRAMS = (3, 4)
DIMENSIONS = 12
TRAIN_ROWS = 1_500
TRAIN_BYTES = 64 << 20
EPOCHS = 5
RATE = 0.5
SEED = 11
#: Buckets that are not hashed into.
ALWAYS, SAME, FIRST = 0, 1, 2


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS - FIRST)).astype(np.int32) + FIRST


def features(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Kinds of features of the texts, one after the other: (buckets, where each text's ones begin; one more at the end)."""
    words, bounds = word_hashes(data, at, UNBROKEN, EXACT)
    yield _bucket(words), bounds
    if len(words) > 1:
        pair = _bucket(mix(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]))
        pair[words[:-1] == words[1:]] = SAME
        inside = np.ones(len(pair), bool)
        last = bounds[1:-1] - 1
        inside[last[(last >= 0) & (last < len(pair))]] = False
        kept = np.concatenate([[0], np.cumsum(inside)])
        yield pair[inside], kept[np.minimum(bounds, len(pair))]
    solid = UNBROKEN[data]
    owner_end = np.zeros(len(data) + 1, bool)
    owner_end[at] = True
    rolling, whole = EXACT[data], solid.copy()
    for n in range(2, max(NGRAMS) + 1):
        if len(data) < n:
            break
        rolling = mix(rolling[:-1]) + EXACT[data[n - 1 :]]
        whole = whole[:-1] & solid[n - 1 :] & ~owner_end[n - 1 : len(data)]
        if n in NGRAMS:
            kept = np.concatenate([[0], np.cumsum(whole)])
            yield _bucket(mix(rolling[whole] + np.uint64(n))), kept[np.minimum(at, len(whole))]


def bags(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(distinct buckets, weights that sum to one) of each text."""
    data, at = text_bytes(texts)
    kinds = list(features(data, at))
    out = []
    for i in range(len(texts)):
        ids, count = np.unique(np.concatenate([[ALWAYS], *(b[lo[i] : lo[i + 1]] for b, lo in kinds)]), return_counts=True)
        out.append((ids, (count / count.sum()).astype(np.float32)))
    return out


def _bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = bags(text_array(batch.column("text")))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array([ids.astype("<i4").tobytes() for ids, _ in found], pa.binary()), pa.array([w.astype("<f4").tobytes() for _, w in found], pa.binary()),
        ], ["doc_id", "ids", "weights"])


def fit(docs: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, share: float) -> np.ndarray:
    """Scores of the buckets (log odds of label 1 for a text made of nothing else); `share` is label 1's true share."""
    rng = np.random.default_rng(SEED)
    vectors = (rng.random((BUCKETS, DIMENSIONS), dtype=np.float32) - 0.5) / DIMENSIONS
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    steps, done = EPOCHS * len(docs), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(docs)).tolist():
            rate = np.float32(RATE * (1 - done / steps))
            ids, weights = docs[i]
            mean = weights @ vectors[ids]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[i]] -= 1
            back = layer @ p
            layer -= rate * np.outer(mean, p)
            bias -= rate * p
            # Averages make each bucket's gradient tiny; a text's vectors move together by the rate.
            vectors[ids] -= (rate * len(ids)) * np.minimum(weights, 4 / len(ids))[:, None] * back
            done += 1
    odds = layer[:, 1] - layer[:, 0]
    drawn = labels.mean()
    prior = np.log(share / (1 - share)) - np.log(drawn / (1 - drawn))
    return (vectors @ odds + (bias[1] - bias[0]) + prior).astype(np.float32)


def one_label_each(labels: DataFrame, label: str, allowed: Column) -> DataFrame:
    """(doc_id, label) where `allowed` holds; of an id's several labels the smallest counts."""
    return labels.filter(allowed & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("label"))


def train(docs: DataFrame, labels: DataFrame, label: str, allowed: Column, rows: int = TRAIN_ROWS) -> np.ndarray | float:
    """A table of bucket scores from the labelled rows for which `allowed` (over doc_id) holds; a plain share if they don't tell classes apart.

    Fitted on at most `rows` ids of each label and TRAIN_BYTES of text; tasks make the bags, the driver fits.
    """
    own = one_label_each(labels, label, allowed)
    count = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(count.values())
    if len(count) < 2:
        return count.get(1, 0) / total if total else 0.5
    drawn = [own.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows) for k in (0, 1)]
    drawn = drawn[0].unionByName(drawn[1])
    drawn = stored(drawn, "drawn")
    texts = one_text_each(docs, drawn, TRAIN_BYTES)
    kind = texts.schema["doc_id"].dataType.simpleString()
    found = texts.mapInArrow(_bagged, f"doc_id {kind}, ids binary, weights binary").join(F.broadcast(drawn), "doc_id").collect()
    found.sort(key=lambda r: r["doc_id"])
    seen = np.array([r["label"] for r in found], np.int64)
    if len(set(seen.tolist())) < 2:
        return count[1] / total
    return fit([(np.frombuffer(r["ids"], "<i4"), np.frombuffer(r["weights"], "<f4")) for r in found], seen, count[1] / total)


def score(docs: DataFrame, model: np.ndarray | float) -> DataFrame:
    """(doc_id, _id, _hash, score): probability of label 1 for each row of `docs`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in text_chunks(batches):
            if isinstance(model, float):
                found = np.full(len(rows), model)
            else:
                total, count = np.full(len(rows), float(model[ALWAYS])), np.ones(len(rows))
                for buckets, lo in features(data, at):
                    sums = np.concatenate([[0.0], np.cumsum(model[buckets], dtype=np.float64)])
                    total += sums[lo[1:]] - sums[lo[:-1]]
                    count += np.diff(lo)
                found = 1 / (1 + np.exp(-np.clip(total / count, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("doc_id", *KEY)), pa.array(found)], ["doc_id", *KEY, "score"])

    return keyed(docs).mapInArrow(run, "doc_id long, _id long, _hash long, score double")


def predicted(scored: DataFrame, held_out: Column, least: float = 0.7) -> DataFrame:
    """The contract's columns of `score`."""
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= least).cast("int").alias("predicted"))


def remainder(parts: int) -> Column:
    """crc32 of doc_id as text, modulo `parts`; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts
