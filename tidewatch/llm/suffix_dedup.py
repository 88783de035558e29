"""Suffix-array dedup of byte strings of `SIZE` bytes, by blockwise buckets over a difference cover.

Every byte covered by a SIZE-byte string that also starts elsewhere goes; overlaps count, and
strings are judged on the input. A full suffix array of the corpus would be many times its size,
so suffixes are sorted one bucket at a time, and only those that can be tied at all:

1. Cover sample. `COVER` is a perfect difference set modulo `PERIOD` (Singer's construction): for
   any two suffixes s and t some d < PERIOD puts s + d and t + d both into the sample. The sample
   suffixes (8 in 100) are ranked first: sorted bucket by bucket by their next `SIZE - PERIOD + 1`
   bytes; a rank held twice or more is a tie.
2. Two suffixes equal in SIZE bytes have tied sample suffixes within PERIOD bytes. So only
   suffixes with a tied sample suffix within reach enter the second sort: bucket by bucket, by
   their SIZE bytes. A suffix whose key occurs twice starts a repeated string.

Suffixes are not ordered by their bytes: a suffix that carried its next bytes and ranks would move some fifty
bytes for each byte of text. Keys are 62-bit fingerprints (polynomials modulo two primes, at bases drawn
for each run), sorted inside buckets; a tie is equality of fingerprints, which two given strings of
400 bytes have by chance once in 2**62 runs, and at most (400 / 2**31)**2 of the time if they were made for it. Copies of whole texts are set aside first: they are
removed whole (from SIZE bytes on), and one of them stands for all in both sorts.

Memory: a task holds one chunk of text or one bucket; the number of buckets follows the bytes of
text. Before anything is shuffled a chunk sends each distinct key once, so a string that a third
of all texts hold arrives once for each chunk. What comes back is one bit for each key sent.

Null text counts as empty. Repeated rows are copies of each other.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.llm.common import KEY, keyed, small_enough, stored, text_chunks
from tidewatch.llm.shingles import mix

SIZE = 400
FIELD = 13
PERIOD = FIELD * FIELD + FIELD + 1
CHUNK = 4 << 20
BUCKET_KEYS = 3_000_000


def difference_cover(q: int) -> list[int]:
    """q + 1 residues modulo q*q + q + 1 whose differences are all residues: zeros of a linear recurrence over GF(q)."""
    period = q * q + q + 1
    for a, b, c in product(range(q), range(q), range(1, q)):
        x, zeros = (0, 0, 1), []
        for i in range(period):
            if x[0] == 0:
                zeros.append(i)
            x = (x[1], x[2], (a * x[0] + b * x[1] + c * x[2]) % q)
        if len(zeros) == q + 1 and len({(u - w) % period for u in zeros for w in zeros}) == period:
            return zeros
    raise ValueError(f"no difference set for {q}")


COVER = np.array(difference_cover(FIELD))
#: Two primes under 2**31: products fit 64 bits, and so do sums over a chunk of up to 2**33 bytes.
PRIMES = (2**31 - 1, 2**31 - 19)
_powers: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """Powers 0..n-1 of the base modulo the prime, by doubling; the last ones are kept for the next chunk."""
    found = _powers.get((base, prime), np.ones(1, np.uint64))
    while len(found) < n:
        found = np.concatenate([found, found * np.uint64(pow(base, len(found), prime)) % np.uint64(prime)])
    if (base, prime) not in _powers and len(_powers) >= 8:
        _powers.clear()
    _powers[base, prime] = found
    return found[:n]


def fingerprints(data: np.ndarray, starts: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Fingerprint of the `width` bytes from each start; starts don't reach beyond the data.

    A polynomial in the bytes modulo each prime at a base drawn from the seed, which is drawn anew for each
    run: no pair of strings is equal for more than `width` of the 2**31 bases of a prime.
    """
    draw, n, out = np.random.default_rng(seed), len(data), np.zeros(len(starts), np.uint64)
    for prime in PRIMES:
        base, p = int(draw.integers(2**20, prime - 1)), np.uint64(prime)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(pow(base, -1, prime), prime, n) % p, out=sums[1:])
        out = out * np.uint64(2**31) + (sums[starts + width] - sums[starts]) % p * powers(base, prime, n)[starts] % p
    return out


def sample_starts(length: int) -> np.ndarray:
    """Places of the cover sample in a text, as far as their key fits."""
    last = length - (SIZE - PERIOD + 1)
    if last < 0 or length < SIZE:
        return np.zeros(0, np.int64)
    all_places = (np.arange(0, last + 1, PERIOD)[:, None] + COVER).ravel()
    return all_places[all_places <= last]


def near_starts(length: int, tied: np.ndarray) -> np.ndarray:
    """Suffixes of a text that have a tied sample place within PERIOD bytes and SIZE bytes left."""
    reach = np.zeros(max(0, length - SIZE + 1) + 1, np.int32)
    low = np.maximum(tied - PERIOD + 1, 0)
    low, high = low[low < len(reach)], np.minimum(tied + 1, len(reach) - 1)[low < len(reach)]
    np.add.at(reach, low, 1)
    np.add.at(reach, high, -1)
    return np.flatnonzero(np.cumsum(reach)[:-1] > 0)


def distinct_keys(data: np.ndarray, starts: np.ndarray, width: int, buckets: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of a chunk sorted by (bucket, key), each once: (bucket, key, the key's number for each start, how often it occurs)."""
    key = fingerprints(data, starts, width, seed)
    bucket = (mix(key) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((key, bucket))
    k, b = key[order], bucket[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (b[1:] != b[:-1])
    number = np.empty(len(k), np.int64)
    number[order] = np.cumsum(new) - 1
    return b[new], k[new], number, np.bincount(number, minlength=int(new.sum()))


def planes(keys: np.ndarray) -> bytes:
    """Sorted keys byte plane by byte plane: the high ones hardly change, so the shuffle's codec shrinks them."""
    return keys.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unplaned(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def chunk_starts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, suffix starts in them, each start's text) of a chunk row with ends and tied sample places."""
    data, ends = np.frombuffer(row["data"], np.uint8), np.array(row["ends"], np.int64)
    begins = np.concatenate([[0], ends[:-1]])
    tied = [np.frombuffer(t, np.uint32).astype(np.int64) for t in row["tied"]]
    found = [near_starts(int(e - b), t) + b for b, e, t in zip(begins, ends, tied)]
    return data, np.concatenate(found), np.repeat(np.arange(len(found)), [len(f) for f in found])


def _sent(chunk: int, data: np.ndarray, starts: np.ndarray, width: int, buckets: int, seed: int) -> Iterator[pa.RecordBatch]:
    bucket, key, _, _ = distinct_keys(data, starts, width, buckets, seed)
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    parts = list(zip(cut.tolist(), [*cut[1:].tolist(), len(bucket)]))
    yield pa.RecordBatch.from_arrays([
        pa.array(bucket[cut], pa.int64()), pa.array([chunk] * len(cut), pa.int64()), pa.array([planes(key[a:b]) for a, b in parts], pa.binary()),
    ], ["bucket", "chunk", "keys"])


def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket at a time: which of the keys each chunk sent are held by another chunk, as bits."""
    def judge(bucket, rows):
        keys = [unplaned(r) for _, r in rows]
        joined = np.concatenate(keys)
        order = np.argsort(joined)
        same = joined[order][1:] == joined[order][:-1]
        tied = np.zeros(len(joined), bool)
        tied[order[1:][same]] = tied[order[:-1][same]] = True
        at = np.cumsum([0, *map(len, keys)])
        bits = [np.packbits(tied[a:b]).tobytes() for a, b in zip(at[:-1], at[1:])]
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int64()), pa.array([bucket] * len(rows), pa.int64()), pa.array(bits, pa.binary())], ["chunk", "bucket", "bits"])

    bucket, rows = None, []
    for batch in batches:
        for b, chunk, keys in zip(*(batch.column(c).to_pylist() for c in ("bucket", "chunk", "keys"))):
            if rows and b != bucket:
                yield judge(bucket, rows)
                rows = []
            bucket = b
            rows.append((chunk, keys))
    if rows:
        yield judge(bucket, rows)


def tied_starts(data: np.ndarray, starts: np.ndarray, width: int, buckets: int, seed: int, answers: list[dict]) -> np.ndarray:
    """Which starts are tied, from the bits that came back for this chunk and from ties inside it."""
    bucket, key, number, count = distinct_keys(data, starts, width, buckets, seed)
    tied = count > 1
    for x in answers:
        mine = np.flatnonzero(bucket == x["bucket"])
        tied[mine] |= np.unpackbits(np.frombuffer(x["bits"], np.uint8))[: len(mine)].astype(bool)
    return tied[number]


def _chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, data, at in text_chunks(batches, size=CHUNK):
        ids = pa.array([rows.column("_id").to_pylist()], pa.list_(pa.int64())), pa.array([rows.column("_hash").to_pylist()], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*ids, pa.array([at[1:].tolist()], pa.list_(pa.int64())), pa.array([data.tobytes()], pa.large_binary()).cast(pa.binary())], ["ids", "hashes", "ends", "data"])


def _all_sample_starts(ends: np.ndarray) -> np.ndarray:
    begins = np.concatenate([[0], ends[:-1]])
    return np.concatenate([sample_starts(int(e - b)) + b for b, e in zip(begins, ends)])


def _send(buckets: int, sample: bool, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = np.frombuffer(row["data"], np.uint8)
                starts = _all_sample_starts(np.array(row["ends"], np.int64)) if sample else chunk_starts(row)[1]
                yield from _sent(row["chunk"], data, starts, SIZE - PERIOD + 1 if sample else SIZE, buckets, seed)

    return run


def _tie_samples(buckets: int, seed: int):
    """Chunks with answers in; out: the texts that hold a tied sample place, with these places, in chunks of the same numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, ends = np.frombuffer(row["data"], np.uint8), np.array(row["ends"], np.int64)
                starts = _all_sample_starts(ends)
                tied = starts[tied_starts(data, starts, SIZE - PERIOD + 1, buckets, seed, row["answers"] or [])]
                begins = np.concatenate([[0], ends[:-1]])
                lo = np.searchsorted(tied, begins), np.searchsorted(tied, ends)
                keep = [i for i in range(len(ends)) if lo[1][i] > lo[0][i]]
                if keep:
                    parts = [row["data"][begins[i] : ends[i]] for i in keep]
                    own = [(tied[lo[0][i] : lo[1][i]] - begins[i]).astype(np.uint32).tobytes() for i in keep]
                    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.binary()]
                    values = [row["chunk"], [row["ids"][i] for i in keep], [row["hashes"][i] for i in keep], np.cumsum([len(p) for p in parts]).tolist(), own, b"".join(parts)]
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], ["chunk", "ids", "hashes", "ends", "tied", "data"])

    return run


def _cut(buckets: int, seed: int):
    """Chunks of texts with answers in; out: for each text with a repeated string the removed runs and the rest's digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data, starts, owner = chunk_starts(row)
                repeated = tied_starts(data, starts, SIZE, buckets, seed, row["answers"] or [])
                starts, owner = starts[repeated], owner[repeated]
                begins = [0, *row["ends"][:-1]]
                out = []
                for i in np.unique(owner).tolist():
                    at = starts[owner == i] - begins[i]
                    first = np.flatnonzero(np.concatenate([[True], np.diff(at) > SIZE]))
                    runs = list(zip(at[first].tolist(), (at[np.concatenate([first[1:] - 1, [len(at) - 1]])] + SIZE).tolist()))
                    text, digest, p = row["data"][begins[i] : row["ends"][i]], hashlib.sha256(), 0
                    for a, b in runs:
                        digest.update(text[p:a])
                        p = b
                    digest.update(text[p:])
                    out.append((row["ids"][i], row["hashes"][i], [{"begin": a, "end": b} for a, b in runs], digest.hexdigest()))
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())])), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], ["_id", "_hash", "runs", "kept"])

    return run


def _answered(chunks: DataFrame, send, buckets: int, label: str) -> DataFrame:
    """`chunks` with the answers to what they send: sorted bucket by bucket, joined back by chunk."""
    sent = chunks.mapInArrow(send, "bucket long, chunk long, keys binary").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    bits = sent.mapInArrow(_sorted_buckets, "chunk long, bucket long, bits binary")
    answers = stored(bits.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("answers")), label)
    small = small_enough(answers, F.aggregate("answers", F.lit(0), lambda n, x: n + F.octet_length(x["bits"]) + 16))
    return chunks.join(F.broadcast(answers) if small else answers, "chunk", "left")


def removed(docs: DataFrame) -> DataFrame:
    """(doc_id, _id, _hash, n_bytes, runs, kept_sha256): one row for each row of `docs`; runs are [begin, end) in bytes."""
    whole = keyed(docs).select("doc_id", *KEY, F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    whole, seed = stored(whole, "texts"), secrets.randbits(60)
    # Groups of copies are few against rows; the join goes without an exchange by `sha` as long as they fit.
    groups = stored(whole.groupBy("sha").agg(F.count("*").alias("copies"), F.min(F.struct(*KEY)).alias("first")).filter("copies > 1"), "groups")
    copies = stored(whole.join(F.broadcast(groups) if small_enough(groups, 96) else groups, "sha").select("doc_id", *KEY, "n_bytes", (F.struct(*KEY) == F.col("first")).alias("stands")), "copies")
    aside = stored(copies.filter("NOT stands").select(*KEY).distinct(), "aside")
    total = whole.filter(f"n_bytes >= {SIZE}").agg(F.sum("n_bytes")).first()[0] or 0
    buckets = max(1, -(-int(total * len(COVER) / PERIOD) // BUCKET_KEYS))

    texts = keyed(docs).filter(F.octet_length("text") >= SIZE).join(F.broadcast(aside) if small_enough(aside, 16) else aside, KEY, "left_anti")
    chunks = texts.select(*KEY, "text").mapInArrow(_chunked, "ids array<long>, hashes array<long>, ends array<long>, data binary")
    chunks = stored(chunks.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    ranked = _answered(chunks, _send(buckets, True, seed), buckets, "ranks")
    near = stored(ranked.mapInArrow(_tie_samples(buckets, seed), "chunk long, ids array<long>, hashes array<long>, ends array<long>, tied array<binary>, data binary"), "near")
    within = near.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    buckets = max(1, -(-int(within) // BUCKET_KEYS))
    found = _answered(near, _send(buckets, False, seed), buckets, "suffixes")
    cut = stored(found.mapInArrow(_cut(buckets, seed), "_id long, _hash long, runs array<struct<begin: long, end: long>>, kept string").dropDuplicates(KEY), "cut")

    gone = copies.filter(f"n_bytes >= {SIZE}").select(*KEY).distinct().withColumn("gone", F.lit(True))
    all_rows = whole.join(cut, KEY, "left").join(gone, KEY, "left")
    full = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<begin: long, end: long>>")
    return all_rows.select(
        "doc_id", *KEY, "n_bytes", F.when(F.col("gone"), full).otherwise(F.coalesce("runs", none)).alias("runs"),
        F.when(F.col("gone"), F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept", "sha")).alias("kept_sha256"),
    )


def digest(found: DataFrame, passages: DataFrame | None = None) -> DataFrame:
    """The contract's columns of `removed`; with `passages` (see `passages.shared`) also has_repeats.

    has_repeats: bytes were removed, or the document holds a passage that another one holds too, also one of
    fewer than SIZE bytes, which loses nothing.
    """
    gone = F.aggregate("runs", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["begin"])
    columns = ["doc_id", "n_bytes", gone.alias("n_removed"), F.size("runs").cast("long").alias("n_spans"), "kept_sha256"]
    if passages is None:
        return found.select(*columns)
    marked = found.join(passages.withColumn("_shared", F.lit(True)), KEY, "left")
    return marked.select(*columns, (F.col("_shared").isNotNull() | (F.size("runs") > 0)).alias("has_repeats"))
