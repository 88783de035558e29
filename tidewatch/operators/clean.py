"""Deduplication of rows; column-wise cleaning lives in `stages`."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.joins import BROADCAST_BYTES
from tidewatch.functions.scalars import digested
from tidewatch.functions.storage import materialize


COPIES = "_copies"


def dedup_global(df: DataFrame) -> DataFrame:
    """One copy of every distinct row. Copies collapse inside each task before the shuffle."""
    return df.dropDuplicates()


def dedup_in_class(df: DataFrame, column: str, value: str) -> DataFrame:
    """Drop exact copies only inside one class; other rows keep their copies and are not shuffled."""
    inside = F.col(column).eqNullSafe(F.lit(value))
    return df.where(inside).dropDuplicates().unionByName(df.where(~inside))


def mark_duplicates(df: DataFrame, keys: list[str], row_id: str, output: str = "is_duplicate") -> DataFrame:
    """True for every occurrence after the first by `row_id`.

    The first row of each key is found by an aggregate and joined back on the unique row id,
    so a key with very many copies never gathers in one task.
    """
    first = df.groupBy(*keys).agg(F.min(row_id).alias(row_id)).select(row_id, F.lit(True).alias("_first"))
    return df.join(first, row_id, "left").withColumn(output, F.col("_first").isNull()).drop("_first")


def verified_distinct(df: DataFrame) -> tuple[DataFrame, int]:
    """Safety dedup before training: the distinct rows and how many copies were dropped.

    The rows are stored once, since splitting and fitting read them many times, each with the number of its copies;
    the answer reads that column alone.
    """
    stored = materialize(df.groupBy(*df.columns).agg(F.count("*").alias(COPIES)))
    return stored.drop(COPIES), stored.agg(F.coalesce(F.sum(F.col(COPIES) - 1), F.lit(0))).first()[0]


#: Rows of a file that one bitmap covers: 4 KB, a bit for each.
BLOCK_ROWS = 32_768


def first_rows(scan: DataFrame, columns: list[str]) -> DataFrame:
    """(_file, _block, _bits): of all rows equal in `columns`, the address of the first, as bitmaps over the rows of the files.

    `scan` reads Parquet files. Texts are compared by their digests, so neither texts nor rows are shuffled: a row is
    its digests and its address, and copies collapse inside each task.
    """
    file, row = F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")
    addressed = scan.select(*columns, F.struct(file, row).alias("_at"))
    winners = digested(addressed).groupBy(*columns).agg(F.min("_at").alias("_at")).select("_at.*")
    block = F.floor(F.col("_row") / BLOCK_ROWS).alias("_block")
    return winners.groupBy("_file", block).agg(F.bitmap_construct_agg(F.col("_row") % BLOCK_ROWS).alias("_bits"))


def dedup_files(scan: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The first row of each group of rows of Parquet files that are equal in `columns` (all, if none are given).

    The files are read twice, and each row looks up its own bit: bitmaps take a bit a row (16 MB for 130 million) and are
    broadcast while their counted size allows; beyond that the look-up is a shuffle join.
    """
    names = columns or scan.columns
    bits = materialize(first_rows(scan, names))
    small = bits.count() * BLOCK_ROWS // 8 <= BROADCAST_BYTES
    row = F.col("_metadata.row_index")
    addressed = scan.select(*scan.columns, F.col("_metadata.file_path").alias("_file"), F.floor(row / BLOCK_ROWS).alias("_block"), (row % BLOCK_ROWS).alias("_place"))
    place = F.col("_place")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    wanted = F.getbit(byte, (place % 8).cast("int")) == 1
    return addressed.join(F.broadcast(bits) if small else bits, ["_file", "_block"]).where(wanted).select(*scan.columns)
