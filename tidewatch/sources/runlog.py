"""Run log with idempotent append, and data fingerprints."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.functions.scalars import text

FINISHED = "FINISHED"
SEPARATOR = "\x1f"
ABSENT = "\x00"
ATTEMPT, WRITTEN = "_attempt", "_written"


def row_digest(columns: list[str]) -> Column:
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(text(F.col(c)), F.lit(ABSENT)) for c in columns]).cast("binary"))


def table_fingerprint(df: DataFrame, portable: bool = False) -> DataFrame:
    """(rows, checksum) independent of row order and partitioning.

    The sum of 64-bit row hashes; `portable` uses the leading 60 bits of an md5 over the
    cells as text instead, so that other engines can check it.
    """
    if portable:
        hashed = F.conv(F.substring(row_digest(df.columns), 1, 15), 16, 10)
    else:
        hashed = F.xxhash64(*[F.col(c) for c in df.columns])
    checksum = F.coalesce(F.sum(hashed.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)"))
    return df.agg(F.count("*").alias("rows"), checksum.cast("string").alias("checksum"))


def flatten_parameters(parameters: Mapping[str, object]) -> dict[str, Column]:
    """Literals for simple values, JSON text for lists and maps."""
    flat = {}
    for name, value in parameters.items():
        if isinstance(value, dict):
            flat[name] = F.to_json(F.create_map(*[F.lit(x) for pair in value.items() for x in pair]))
        elif isinstance(value, (list, tuple)):
            flat[name] = F.to_json(F.array(*[F.lit(x) for x in value]))
        else:
            flat[name] = F.lit(value)
    return flat


def report_row(metrics: DataFrame, run_name: str, algorithm: str, parameters: Mapping[str, object], fingerprint: str) -> DataFrame:
    """One run: name, algorithm, parameters, metrics as a map, fingerprint, status.

    `metrics` has one row per metric, a handful by construction.
    """
    packed = metrics.agg(F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("metrics"))
    flat = [c.cast("string").alias(n) for n, c in flatten_parameters(parameters).items()]
    return packed.select(
        F.lit(run_name).alias("run_name"), F.lit(algorithm).alias("algorithm"),
        F.to_json(F.struct(*flat)).alias("parameters"), "metrics",
        F.lit(fingerprint).alias("fingerprint"), F.lit(FINISHED).alias("status"),
    )


def new_runs(log: DataFrame, runs: DataFrame, key: str = "fingerprint") -> DataFrame:
    """Runs whose fingerprint has not finished yet, each fingerprint once."""
    return runs.dropDuplicates([key]).join(log.where(F.col("status") == FINISHED).select(key), key, "left_anti").select(*runs.columns)


def append_runs(log_path: str, runs: DataFrame, writer: str | None = None) -> None:
    """Append the runs that have not finished yet to the Parquet log, without a lock; repeating the call adds nothing.

    Every call writes into a folder of its own (`writer`, drawn if not given), so any number of writers may
    append at once; what they can't see of each other `read_runs` settles. A call that is repeated under its
    name does not count its own folder as finished and writes it again.
    """
    name, spark = writer or uuid.uuid4().hex, runs.sparkSession
    try:
        log = spark.read.option("basePath", log_path).parquet(log_path)
        runs = new_runs(log.where(F.col(ATTEMPT).cast("string") != name), runs)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition() or error):
            raise
    runs.withColumn(WRITTEN, F.current_timestamp()).write.mode("overwrite").parquet(f"{log_path}/{ATTEMPT}={name}")


def read_runs(log_path: str, spark: SparkSession, key: str = "fingerprint") -> DataFrame:
    """The log with each finished fingerprint once: the attempt that was written first, by its name among equals.

    Runs that have not finished stay as often as they were logged. All readers that see the same folders
    settle alike, whatever the order in which writers came.
    """
    log = spark.read.option("basePath", log_path).parquet(log_path)
    columns = [c for c in log.columns if c not in (ATTEMPT, WRITTEN)]
    done = F.col("status") == FINISHED
    rank = F.struct(F.col(WRITTEN), F.col(ATTEMPT).cast("string"), F.xxhash64(*columns))
    first = log.where(done).groupBy(key).agg(F.min_by(F.struct(*columns), rank).alias("_run")).select("_run.*")
    return first.unionByName(log.where(~F.coalesce(done, F.lit(False))).select(*columns))
