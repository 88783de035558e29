"""Packing token pieces into sequences of fixed length by best-fit decreasing.

Documents are encoded, an end id is put after each, and documents longer than a window are first
cut into full windows. What is left (shorter than a window) is placed longest first, each piece
into the open window with the least room that still takes it. The tightest window is found by a
segment tree whose leaves are the remaining capacities: a node says whether any window with a
capacity in its range is open, so one walk of log2(window) steps answers a query.

Pieces are dealt to groups of about `GROUP_BYTES` of text by a hash of id, text, the row's number in its partition and
the piece's place, so that neither a repeated row nor a very long document fills one group; a group is one task's
work, of bounded size at any scale, and packs alone. Its only cost is the one or two windows left
partly open at its end. Sequence ids are `place in group * groups + group`: unique without a
prefix sum.

Null text counts as empty: a piece with the end id alone. Repeated rows and null ids are packed
each as a document of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import KEY, keyed, text_chunks
from tidewatch.llm.shingles import mix
from tidewatch.llm.tokens import Encoder, with_end

WINDOW = 2048
GROUP_BYTES = 24 << 20


class OpenWindows:
    """Open windows by remaining capacity, under a segment tree over the capacities 0..window."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.stacks: dict[int, list[int]] = {}

    def _add(self, capacity: int, by: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.stacks.setdefault(capacity, []).append(window)
        self._add(capacity, 1)

    def tightest(self, length: int) -> tuple[int, int] | None:
        """Take out the window with the smallest capacity of at least `length`: (capacity, window)."""
        node, count = self.leaves + length, self.count
        if not count[node]:
            # Up to the first right sibling that holds an open window, then down its left edge.
            while node > 1 and (node & 1 or not count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.stacks[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, int]:
    """For pieces of at most `window`: the window and the offset of each, and the number of windows used."""
    place, offset, used = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    windows = OpenWindows(window)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        found = windows.tightest(n) if n < window else None
        if found is None:
            found, used = (window, used), used + 1
        room, place[i] = found
        offset[i] = window - room
        if room > n:
            windows.put(room - n, found[1])
    return place, offset, used


def _pieces(path: str, end: int, window: int, groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, rows_before = Encoder.of(path), 0
        for rows, data, at in text_chunks(batches):
            ids, bounds = with_end(*encoder.encode(data, at), end)
            size = np.diff(bounds)
            pieces = -(-size // window)
            doc = np.repeat(np.arange(len(size)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
            length = np.minimum(window, size[doc] - start)
            begin = bounds[:-1][doc] + start
            # Ids travel in two bytes where the vocabulary allows it.
            narrow = ids.astype("<u2") if ids.max(initial=0) < 1 << 16 else ids.astype("<u4")
            payload = [narrow[a : a + n].tobytes() for a, n in zip(begin.tolist(), length.tolist())]
            take = pa.array(doc)
            key = np.asarray(rows.column("_id")).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(rows.column("_hash")).view(np.uint64)
            key = mix(key + np.arange(rows_before, rows_before + len(rows)).astype(np.uint64))
            rows_before += len(rows)
            group = (mix(key[doc] + (start // window).astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array(group), *(rows.column(c).take(take) for c in ("doc_id", "_hash")),
                pa.array(start), pa.array(length), pa.array(size[doc]), pa.array(payload, pa.binary()),
            ], ["group", "doc_id", "_hash", "start", "length", "doc_tokens", "payload"])

    return run


def _packed(groups: int, window: int):
    def pack_group(pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by([("doc_id", "ascending"), ("_hash", "ascending"), ("start", "ascending")]).combine_chunks()
        length = pieces["length"].to_numpy()
        place, offset, _ = best_fit_decreasing(length, window)
        group = pieces["group"][0].as_py()
        ids = [np.frombuffer(p, "<u2" if len(p) == 2 * n else "<u4").astype("<u4").tobytes() for p, n in zip(pieces["payload"].to_pylist(), length.tolist())]
        return pa.table({
            "doc_id": pieces["doc_id"], "start": pieces["start"], "length": pieces["length"], "doc_tokens": pieces["doc_tokens"],
            "sequence_id": place * groups + group, "offset": offset, "ids": pa.array(ids, pa.binary()),
        })

    return pack_group


def pack(docs: DataFrame, tokenizer: str, end: int, window: int = WINDOW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, start, length, doc_tokens, sequence_id, offset, ids): one row for each piece, ids as little-endian uint32."""
    # A document without text still is a piece, so a few bytes stand for each row.
    size = docs.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16), F.lit(0))).first()[0]
    groups = max(1, -(-size // group_bytes))
    pieces = keyed(docs).select("doc_id", *KEY, "text").mapInArrow(
        _pieces(tokenizer, end, window, groups),
        "group long, doc_id long, _hash long, start long, length long, doc_tokens long, payload binary",
    )
    return pieces.groupBy("group").applyInArrow(
        _packed(groups, window), "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, doc_ids, ids): the ids of each sequence joined in order, unpadded."""
    joined = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("_p"), F.sum("length").alias("n_tokens"))
    hexes = F.array_join(F.transform("_p", lambda p: F.hex(p["ids"])), "")
    return joined.select("sequence_id", "n_tokens", F.transform("_p", lambda p: p["doc_id"]).alias("doc_ids"), F.unhex(hexes).alias("ids"))


def digest(packed: DataFrame) -> DataFrame:
    """The contract's columns of `pack`."""
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
