"""Toxicity by non-negative positive-unlabelled learning.

Positives are confirmed toxic documents; the unlabelled side is a sample of all documents, toxic
ones among it. With the class prior `p`, loss l and model g, the risk is

    p * E_P[l(g)] + max(0, E_U[l(-g)] - p * E_P[l(-g)])

where the second term stands for the negatives' risk and is kept from falling below zero: while a
batch's estimate is under zero, the step goes the other way (Kiryo et al. 2017). The model is
linear over hashed words (letters and digits, A-Z lowered) and their beginnings of `PREFIXES`
bytes, each counted as its share of the text's words times `FULL`, one at most. Features in fewer
than `LEAST_DOCS` training texts keep weight zero, and weights are shrunk. Training is numpy, with
logistic loss.

The prior comes from the labels that may be used; confirmed non-toxic ones among them serve only to
calibrate (slope and offset of the logit, by Newton steps with Platt's smoothed targets). Bounds:
`POSITIVE_ROWS` toxic, `UNLABELLED_ROWS` of all documents, `CALIBRATION_ROWS` labelled documents,
each those with the smallest hashes of their id; whole texts.

Null text counts as empty and gets the score of the bias. Repeated rows are all returned. Without
a confirmed toxic document the score is 0 for every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.llm.common import KEY, keyed, one_text_each, stored, text_chunks
from tidewatch.llm.quality_classifier import one_label_each
from tidewatch.llm.shingles import ALNUM, LOWERED, mix, word_hashes, word_spans

BUCKETS = 1 << 18
POSITIVE_ROWS = 2_000
UNLABELLED_ROWS = 4_000
CALIBRATION_ROWS = 4_000
TRAIN_BYTES = 96 << 20
PREFIXES = (4, 5, 6, 7, 8)
FULL = 20
LEAST_DOCS = 5
EPOCHS = 20
BATCHES = 20
RATE = 0.01
SHRINK = 1e-3
SEED = 13


@dataclass
class Model:
    """One weight for each bucket, and the calibrated logit `slope * value + offset`."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def logit(self, value: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * (value + self.bias) + self.offset, -30, 30)


Bag = tuple[np.ndarray, np.ndarray, np.ndarray]


def word_bags(data: np.ndarray, at: np.ndarray) -> Bag:
    """Distinct buckets of the texts one after the other, where each text's ones begin, and their weights."""
    words, bounds = word_hashes(data, at, ALNUM, LOWERED)
    starts, ends = word_spans(data, at, ALNUM)
    owner = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(bounds))
    keys = [owner * BUCKETS + (words % np.uint64(BUCKETS)).astype(np.int64)]
    padded, rolling = np.concatenate([data, np.zeros(max(PREFIXES), np.uint8)]), np.zeros(len(starts), np.uint64)
    for k in range(max(PREFIXES)):
        rolling = mix(rolling) + LOWERED[padded[starts + k]]
        if k + 1 in PREFIXES:
            whole = ends - starts > k
            keys.append(owner[whole] * BUCKETS + (mix(rolling[whole] + np.uint64(k)) % np.uint64(BUCKETS)).astype(np.int64))
    both, count = np.unique(np.concatenate(keys), return_counts=True)
    share = count / np.diff(bounds)[both // BUCKETS]
    return (both % BUCKETS).astype(np.int32), np.searchsorted(both, np.arange(len(at)) * BUCKETS), np.minimum(1.0, FULL * share)


def _bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, at in text_chunks(batches):
        ids, lo, share = word_bags(data, at)
        cut = lambda x, kind: pa.array([x[a:b].astype(kind).tobytes() for a, b in zip(lo[:-1], lo[1:])], pa.binary())
        yield pa.RecordBatch.from_arrays([rows.column("doc_id"), cut(ids, "<i4"), cut(share, "<f4")], ["doc_id", "ids", "weights"])


def joined(rows: list) -> Bag:
    """The bags of collected rows as one."""
    ids, share = ([np.frombuffer(r[c], kind) for r in rows] for c, kind in (("ids", "<i4"), ("weights", "<f4")))
    return np.concatenate([*ids, np.zeros(0, np.int32)]), np.cumsum([0, *map(len, ids)]), np.concatenate([*share, np.zeros(0, np.float32)])


def values(weights: np.ndarray, bag: Bag) -> np.ndarray:
    ids, lo, share = bag
    sums = np.concatenate([[0.0], np.cumsum(weights[ids] * share)])
    return sums[lo[1:]] - sums[lo[:-1]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(positive: Bag, unlabelled: Bag, prior: float) -> Model:
    """Minimise the non-negative risk by Adam over mini-batches that hold both sides."""
    rng = np.random.default_rng(SEED)
    docs = np.bincount(positive[0], minlength=BUCKETS) + np.bincount(unlabelled[0], minlength=BUCKETS)
    used = np.flatnonzero(docs >= LEAST_DOCS)
    place = np.full(BUCKETS, -1)
    place[used] = np.arange(len(used))

    def texts(bag: Bag) -> list[tuple[np.ndarray, np.ndarray]]:
        ids, lo, share = place[bag[0]], bag[1].tolist(), bag[2]
        return [(ids[a:b][ids[a:b] >= 0], share[a:b][ids[a:b] >= 0]) for a, b in zip(lo[:-1], lo[1:])]

    sides = texts(positive), texts(unlabelled)
    weights, m, v = (np.zeros(len(used) + 1) for _ in range(3))  # the last is the bias
    weights[-1] = np.log(prior / (1 - prior))
    step = 0
    for _ in range(EPOCHS):
        parts = [np.array_split(rng.permutation(len(s)), BATCHES) for s in sides]
        for drawn in zip(*parts):
            if not all(map(len, drawn)):
                continue
            step += 1
            rows = [[side[i] for i in part] for side, part in zip(sides, drawn)]
            joined = [(np.concatenate([r[0] for r in side]), np.concatenate([r[1] for r in side]), np.repeat(np.arange(len(side)), [len(r[0]) for r in side])) for side in rows]
            g = [np.bincount(own, weights[ids] * share, len(side)) + weights[-1] for (ids, share, own), side in zip(joined, rows)]
            negative = np.logaddexp(0, g[1]).mean() - prior * np.logaddexp(0, g[0]).mean()
            # Derivatives of the mean losses by each text's value.
            positive_part = -prior * _sigmoid(-g[0]) / len(g[0])
            negative_part = -prior * _sigmoid(g[0]) / len(g[0]), _sigmoid(g[1]) / len(g[1])
            back = (positive_part + negative_part[0], negative_part[1]) if negative >= 0 else (-negative_part[0], -negative_part[1])
            grad = np.zeros_like(weights)
            for (ids, share, own), d in zip(joined, back):
                grad[:-1] += np.bincount(ids, share * d[own], len(used))
                grad[-1] += d.sum()
            grad[:-1] += SHRINK * weights[:-1]
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            weights -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    full = np.zeros(BUCKETS, np.float32)
    full[used] = weights[:-1]
    return Model(full, float(weights[-1]))


def calibrate(model: Model, bag: Bag, labels: np.ndarray) -> None:
    """Platt scaling on labelled texts: slope and offset by damped Newton steps."""
    x = values(model.weights, bag) + model.bias
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    theta, rows = np.array([1.0, 0.0]), np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(50):
        p = _sigmoid(rows @ theta)
        hessian = (rows * (p * (1 - p))[:, None]).T @ rows + 1e-6 * np.eye(2)
        move = np.linalg.solve(hessian, rows.T @ (p - target))
        theta -= move * min(1.0, 1.0 / max(1e-12, np.abs(move).max()))
    if theta[0] > 0:
        model.slope, model.offset = float(theta[0]), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, label: str, allowed: Column) -> Model | None:
    """Fit on the rows for which `allowed` (over doc_id) holds; others are neither positives nor unlabelled text.

    The prior is the share of label 1 among the labelled rows, taken to be that of all documents.
    """
    own = one_label_each(labels, label, allowed)
    count = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not count.get(1):
        return None
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    first = lambda df, n: df.orderBy(*order).limit(n)
    picked = [
        first(own.filter("label = 1"), POSITIVE_ROWS).select("doc_id", F.lit("p").alias("side"), "label"),
        first(own, CALIBRATION_ROWS).select("doc_id", F.lit("c").alias("side"), "label"),
        first(docs.select("doc_id").filter(allowed), UNLABELLED_ROWS).select("doc_id", F.lit("u").alias("side"), F.lit(-1).alias("label")).distinct(),
    ]
    wanted = picked[0].unionByName(picked[1]).unionByName(picked[2])
    wanted = wanted.groupBy("doc_id").agg(F.collect_set("side").alias("sides"), F.max("label").alias("label"))
    wanted = stored(wanted, "wanted")
    texts = one_text_each(docs, wanted, TRAIN_BYTES)
    kind = texts.schema["doc_id"].dataType.simpleString()
    rows = texts.mapInArrow(_bagged, f"doc_id {kind}, ids binary, weights binary").join(F.broadcast(wanted), "doc_id").collect()
    rows.sort(key=lambda r: r["doc_id"])
    side = {k: [r for r in rows if k in r["sides"]] for k in "pcu"}
    if not side["p"] or not side["u"]:
        return None
    prior = min(0.95, count[1] / sum(count.values()))
    model = fit(joined(side["p"]), joined(side["u"]), prior)
    truth = np.array([r["label"] for r in side["c"]], np.float64)
    if 0 < truth.sum() < len(truth):
        calibrate(model, joined(side["c"]), truth)
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, _id, _hash, score); the model (one megabyte) goes to the tasks with the code."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, data, at in text_chunks(batches):
            found = np.zeros(len(rows)) if model is None else _sigmoid(model.logit(values(model.weights, word_bags(data, at))))
            yield pa.RecordBatch.from_arrays([*(rows.column(c) for c in ("doc_id", *KEY)), pa.array(found)], ["doc_id", *KEY, "score"])

    return keyed(docs).mapInArrow(run, "doc_id long, _id long, _hash long, score double")
