"""Token ids in fixed-width bit packing: each id takes the fewest bits that hold the vocabulary.

Format: a Parquet folder with one row for each block of whole documents, in ascending doc_id order
(ties by text hash; null ids first).

    shard long      range of doc_ids; shards ascend
    block long      number of the block in its shard
    first long      ids of the shard before the block
    bits int        bits for each id
    doc_ids array<long>, ends array<long>   the block's documents and where each one's ids end in it
    payload binary  the ids, least significant bit first, padded to a byte

A block closes when it holds `BLOCK_IDS` ids, so a reader unpacks any block alone with numpy, and
the ids from `a` to `b` of a block start at bit `a * bits`. Parquet carries the rows so that any
store Spark can reach will do, a lost task is written again whole, and a filter on shard, block or
doc_ids skips the rest.

Range bounds of the shards come from approximate quantiles of doc_id; they decide the layout only.
Tokens are shuffled packed, not as text. Null text counts as empty (the end id alone); repeated
rows and null ids are kept, each as a document of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import keyed, text_chunks
from tidewatch.llm.tokens import Encoder, with_end

BLOCK_IDS = 1 << 16
BLOCK_SCHEMA = "shard long, block long, first long, bits int, doc_ids array<long>, ends array<long>, payload binary"


def bit_width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    if bits == 16:
        return ids.astype("<u2").tobytes()
    planes = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, bits: int, begin: int, end: int) -> np.ndarray:
    """Ids begin..end of a block as uint32; reads only the bytes that hold them."""
    if bits == 16:
        return np.frombuffer(payload, "<u2", end - begin, 2 * begin).astype(np.uint32)
    low, high = begin * bits, end * bits
    part = np.frombuffer(payload, np.uint8, (high + 7) // 8 - low // 8, low // 8)
    planes = np.unpackbits(part, bitorder="little")[low % 8 :][: high - low].reshape(-1, bits)
    return (planes.astype(np.uint32) << np.arange(bits, dtype=np.uint32)).sum(axis=1, dtype=np.uint32)


def _encoded(path: str, end: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(path)
        for rows, data, at in text_chunks(batches):
            ids, bounds = with_end(*encoder.encode(data, at), end)
            payload = [pack(ids[a:b], bits) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [rows.column("shard"), rows.column("doc_id"), rows.column("_hash"), pa.array(np.diff(bounds)), pa.array(payload, pa.binary())],
                ["shard", "doc_id", "_hash", "n", "payload"],
            )

    return run


def _blocks(bits: int, block_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, first, docs, ends, parts = None, 0, 0, [], [], []

        def close():
            ids = np.concatenate([unpack(p, bits, 0, n) for p, n in parts])
            row = [[shard], [block], [first], [bits], [docs], [ends], [pack(ids, bits)]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], [x.split()[0] for x in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            for at, doc, n, payload in zip(*(batch.column(c).to_pylist() for c in ("shard", "doc_id", "n", "payload"))):
                if docs and (at != shard or ends[-1] >= block_ids):
                    yield close()
                    block, first, docs, ends, parts = (block + 1, first + ends[-1], [], [], []) if at == shard else (0, 0, [], [], [])
                shard = at
                docs.append(doc)
                ends.append(n + (ends[-1] if ends else 0))
                parts.append((payload, n))
        if docs:
            yield close()

    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end: int, block_ids: int = BLOCK_IDS, shards: int | None = None) -> None:
    """Encode all texts with the tokenizer file, put `end` after each, and write the packed blocks to `folder`."""
    from tokenizers import Tokenizer

    bits = bit_width(max(Tokenizer.from_file(tokenizer).get_vocab_size(), end + 1))
    n = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted(set(docs.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (4 * n)))) if n > 1 else []
    # Null ids come first.
    shard = F.coalesce(_place(F.col("doc_id"), [int(b) for b in bounds]), F.lit(0)).cast("long")
    rows = keyed(docs).withColumn("shard", F.when(F.col("doc_id").isNull(), F.lit(0).cast("long")).otherwise(shard))
    packed = rows.select("shard", "doc_id", "_hash", "text").mapInArrow(
        _encoded(tokenizer, end, bits), "shard long, doc_id long, _hash long, n long, payload binary"
    )
    ordered = packed.repartition(n, "shard").sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "_hash")
    ordered.mapInArrow(_blocks(bits, block_ids), BLOCK_SCHEMA).write.parquet(folder)


def _place(value, bounds: list[int]):
    """How many of the sorted bounds are at or below `value`, as nested comparisons of logarithmic depth."""
    if not bounds:
        return F.lit(0)
    mid = len(bounds) // 2
    return F.when(value < bounds[mid], _place(value, bounds[:mid])).otherwise(_place(value, bounds[mid + 1 :]) + (mid + 1))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            begins = [0, *row["ends"][:-1]]
            ids = unpack(row["payload"], row["bits"], 0, row["ends"][-1]).astype("<u4")
            yield pa.RecordBatch.from_arrays([
                pa.array([row["shard"]] * len(begins)), pa.array(row["doc_ids"], pa.int64()),
                pa.array([row["first"] + b for b in begins], pa.int64()),
                pa.array([ids[a:b].tobytes() for a, b in zip(begins, row["ends"])], pa.binary()),
            ], ["shard", "doc_id", "offset", "ids"])


def read_tokens(spark, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document; ids as little-endian uint32, start over all shards."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(folder)
    # One row for each shard, of which there are as many as partitions were asked for.
    sizes = blocks.groupBy("shard").agg(F.sum(F.element_at("ends", -1)).alias("n"))
    bases = sizes.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    rows = blocks.mapInArrow(_read, "shard long, doc_id long, offset long, ids binary")
    return rows.join(F.broadcast(bases), "shard").select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "ids")


def digest(read: DataFrame) -> DataFrame:
    """The contract's columns of `read_tokens`; Spark's crc32 is the unsigned one."""
    return read.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
