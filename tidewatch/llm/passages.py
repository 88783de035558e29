"""Documents that share a passage of words with another document, by winnowing.

Of every `WINDOW` consecutive hashes of `GRAM` words a document sends the smallest (the last of equals). Two documents that share a run
of GRAM + WINDOW - 1 = 50 words share a whole such window, hence a sent hash; none is missed. Shorter runs
are found by chance only, under GRAM words never. Words are runs without ASCII blanks, as they stand.

A hash that several documents hold is found by the smallest and largest of its documents, so a passage that a
third of all documents hold is one row for each task; the rows of a hot hash are then looked up
by a join that may be split. Null and empty texts share nothing; repeated rows are one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import KEY, keyed, small_enough, stored, text_chunks
from tidewatch.llm.shingles import EXACT, UNBROKEN, mix, word_hashes

GRAM, WINDOW = 36, 15
_STEP = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` words in a row, joined from halves."""
    def joined(a: np.ndarray, b: np.ndarray, after: int) -> np.ndarray:
        n = max(0, min(len(a), len(b) - after))
        return mix(a[:n] * _STEP + b[after : after + n])

    whole, have, part, width = None, 0, words, 1
    while width <= size:
        if size & width:
            whole = part if whole is None else joined(whole, part, have)
            have += width
        part, width = joined(part, part, width), 2 * width
    return whole


def winnowed(words: np.ndarray) -> np.ndarray:
    """The hashes that a document of these words sends, each once."""
    grams = gram_hashes(words, GRAM)
    if len(grams) == 0:
        return grams
    if len(grams) < WINDOW:
        return grams.min(keepdims=True)
    return np.unique(np.lib.stride_tricks.sliding_window_view(grams, WINDOW).min(axis=1))


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, at in text_chunks(batches):
        words, bounds = word_hashes(data, at, UNBROKEN, EXACT)
        found = [winnowed(words[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
        owner = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
        prints = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(prints), *[rows.column(k).take(owner) for k in KEY]], ["print", *KEY])


def shared(docs: DataFrame) -> DataFrame:
    """The keys (_id, _hash) of the documents that share a passage of 50 words or more with another one."""
    sent = stored(keyed(docs).select(*KEY, "text").mapInArrow(_sent, "print long, _id long, _hash long"), "passages")
    twice = sent.groupBy("print").agg(F.min(F.struct(*KEY)).alias("low"), F.max(F.struct(*KEY)).alias("high")).where("low <> high").select("print")
    twice = stored(twice, "shared-passages")
    return sent.join(F.broadcast(twice) if small_enough(twice, 8) else twice, "print", "left_semi").select(*KEY).distinct()
