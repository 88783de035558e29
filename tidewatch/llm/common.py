"""Helpers shared by the operators: row keys, stored tables, size-checked broadcasts, Arrow chunks."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.functions.storage import fresh_folder

#: Largest side that is ever broadcast, measured before it is: rows and bytes.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20
#: Text handled at once inside a task; larger only if one document is.
CHUNK_BYTES = 2 << 20

#: ASCII white space and the separators of letters-and-digits words, as Java / RE2 classes.
BLANK_WORD = r"[^\x20\x09-\x0D]+"
ALNUM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Row key: a document is told apart by its id and its text, so null ids and repeated ids don't mix.
KEY = ["_id", "_hash"]


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did, if it is not installed there."""
    root, paths = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = paths.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(p for p in (known, root) if p)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null becomes empty) and the row key; every other column is left behind."""
    importable(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id", text.alias("text"),
        F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), F.xxhash64(text).alias("_hash"),
    )


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of `docs`, all columns as they are, whose key is not in `gone` (_id, _hash)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.coalesce("doc_id", F.lit(-(2**63))).alias("_id"), F.xxhash64(text).alias("_hash"))
    return rows.join(gone.select(*KEY).distinct(), KEY, "left_anti").select("_row.*")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet to the shared folder and read it back: computed once, lineage cut, columns prunable."""
    path = fresh_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(df: DataFrame, width: Column | int) -> bool:
    """Whether a stored table stays under both broadcast bounds; `width` gives a row's bytes."""
    size = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.lit(width) if isinstance(width, int) else width), F.lit(0)).alias("b")).first()
    return size["n"] <= BROADCAST_ROWS and size["b"] <= BROADCAST_BYTES


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else; the fast path is for texts without other letters."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def text_array(column: pa.Array) -> pa.Array:
    """A string column of a batch with nulls as empty texts and 64-bit offsets."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a large_string array and the offset of each text in them, one more at the end."""
    at = np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
    return data, at - at[0]


def text_chunks(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches holding about `size` bytes of text: (rows, bytes, offsets). Whole texts only."""
    for batch in batches:
        texts, begin = text_array(batch.column(column)), 0
        while begin < len(texts):
            at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset + begin : texts.offset + len(texts) + 1]
            n = max(1, int(np.searchsorted(at, at[0] + size, side="right")) - 1)
            yield batch.slice(begin, n), *text_bytes(texts.slice(begin, n))
            begin += n


def one_text_each(docs: DataFrame, ids: DataFrame, bytes_at_most: int) -> DataFrame:
    """(doc_id, text) for the ids (a bounded table with doc_id): each id once, with its text of the smallest hash.

    Ids are taken by hash while their texts stay within `bytes_at_most` (the first one is taken in any
    case), so what is fitted on is bounded by rows and by bytes, whatever the table repeats.
    """
    found = keyed(docs).join(F.broadcast(ids.select("doc_id").distinct()), "doc_id")
    one = stored(found.groupBy("doc_id").agg(F.min(F.struct("_hash", "text")).alias("x")).select("doc_id", "x.text"), "chosen")
    sizes = one.select("doc_id", F.octet_length("text").alias("n"), F.xxhash64("doc_id").alias("h")).collect()
    left, taken = bytes_at_most, []
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if not taken or r["n"] <= left:
            taken.append((r["doc_id"],))
            left -= r["n"]
    kept = docs.sparkSession.createDataFrame(taken, one.select("doc_id").schema)
    return one.join(F.broadcast(kept), "doc_id")
