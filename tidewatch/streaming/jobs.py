"""Streaming forms of the batch operators.

Each job takes a streaming DataFrame and an output folder on shared storage, and uses the
batch operator for the work, so both give the same rows on the same input. Outputs survive a
retried micro-batch: file sinks commit by batch, and foreachBatch writes overwrite the folder
of their own batch id.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewatch import vocabulary as v
from tidewatch.functions.joins import attach, fits_broadcast
from tidewatch.operators.batches import batch_counts, batch_incidents, batch_verdict, cell_incidents, counted_incidents, route, row_copies
from tidewatch.operators.drift import bucket_counts, drift_status, shares_of, stability
from tidewatch.operators.encode import decide
from tidewatch.operators.service import service_metrics, window_counts
from tidewatch.sources.tables import nan_to_null

BATCH = "_batch"


def file_stream(spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files: int = 1000) -> DataFrame:
    """NaN becomes NULL, as in the table readers. `files` bounds how many files make one micro-batch."""
    return nan_to_null(spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files).parquet(folder))


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.option("basePath", folder).parquet(folder).drop("micro")


def _start(writer, output: str) -> StreamingQuery:
    return writer.option("checkpointLocation", f"{output}/_progress").trigger(availableNow=True).start()


def to_files(df: DataFrame, output: str) -> StreamingQuery:
    """Append the rows of a stream to `output`/data."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", f"{output}/data")
    return _start(writer, output)


def _per_batch(df: DataFrame, output: str, work: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    return _start(df.writeStream.outputMode(mode).foreachBatch(work), output)


def score_stream(stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], score: Column, version: str,
                 keep: Sequence[str], output: str) -> StreamingQuery:
    """Prepare, score and decide row by row; append to `output`/data."""
    scored = decide(prepare(stream), score, version).select(*keep, "anomaly", "anomaly_score", "model_version")
    return to_files(scored, output)


def gate_stream(stream: DataFrame, expected: Mapping[str, str], row_id: str, batch: str | None, output: str,
                allowed: Sequence[str] = v.PROTOCOLS, value_range: tuple[float, float] = v.VALUE_RANGE) -> StreamingQuery:
    """Validate batches. `batch` names the column holding the producer's batch.

    A producer's batch may reach over several micro-batches, so each of these only writes its rows,
    bad cells and counts that add up; `gate_results` reads them. Without `batch` a micro-batch is one
    batch, and its incidents, verdict, accepted rows and quarantine are written at once.
    The micro-batch is cached because several outputs read it.
    """

    def keep(frame: DataFrame, batch_id: int) -> None:
        rows = frame.persist()
        try:
            copies = row_copies(rows, row_id, batch)
            data = F.to_json(F.struct(F.lit(0).alias("_"), *[c for c in copies.columns if c not in (batch, "_n")]))
            digests = copies.select(batch, F.sha2(data, 256).alias("_digest"), "_n")
            parts = {"counts": batch_counts(rows, expected, row_id, batch), "digests": digests, "rows": rows,
                     "cells": cell_incidents(rows, expected, row_id, batch, allowed, value_range)}
            for part, content in parts.items():
                content.write.mode("overwrite").parquet(f"{output}/state/{part}/micro={batch_id}")
        finally:
            rows.unpersist()

    def work(frame: DataFrame, batch_id: int) -> None:
        name = batch or BATCH
        rows = (frame if batch else frame.withColumn(BATCH, F.lit(batch_id))).persist()
        try:
            incidents = batch_incidents(rows, expected, row_id, name, allowed, value_range)
            verdict = batch_verdict(rows, incidents, name)
            accepted, quarantine = route(rows, verdict, name)
            for part, content in (("incidents", incidents), ("verdict", verdict), ("accepted", accepted), ("quarantine", quarantine)):
                content.write.mode("overwrite").parquet(f"{output}/{part}/micro={batch_id}")
        finally:
            rows.unpersist()

    return _per_batch(stream, output, keep if batch else work)


def gate_results(spark: SparkSession, output: str, expected: Mapping[str, str], row_id: str, batch: str) -> dict[str, DataFrame]:
    """Incidents, verdict, accepted and quarantine of all producers' batches that have come in so far."""
    rows, counts, digests, cells = (_stored(spark, f"{output}/state/{part}") for part in ("rows", "counts", "digests", "cells"))
    counts = counts.groupBy(batch).agg(*[F.sum(c).alias(c) for c in counts.columns if c != batch])
    copies = digests.groupBy(batch, "_digest").agg(F.sum("_n").alias("_n"))
    data_columns = [c for c in rows.columns if c not in (row_id, batch)]
    incidents = counted_incidents(counts, copies, data_columns, expected, batch).unionByName(cells)
    verdict = batch_verdict(counts, incidents, batch)
    accepted, quarantine = route(rows, verdict, batch)
    return {"incidents": incidents, "verdict": verdict, "accepted": accepted, "quarantine": quarantine}


def _psi(actual: DataFrame, expected: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    known = expected.select("feature", F.col("shares").alias("_expected"))
    psi = F.when((F.col("n") > 0) & F.col("_expected").isNotNull(), stability(F.col("_expected"), F.col("shares"))).otherwise(0.0)
    found = attach(actual, known, ["feature"], "left", small).select("feature", *keys, psi.alias("psi"))
    return found.withColumn("status", drift_status(F.col("psi")))


def drift_stream(stream: DataFrame, edges: DataFrame, expected: DataFrame, keys: Sequence[str], output: str,
                 buckets: int = v.PSI_BUCKETS) -> StreamingQuery:
    """PSI of long rows (feature, value, keys…) against stored reference shares.

    Every micro-batch writes its bucket counts, which `total_drift` adds up, and its own PSI. `edges` (feature, edges) and `expected` (feature, shares) are fitted once on the
    reference and stored; a micro-batch only counts.
    """

    small = fits_broadcast(edges)
    names = ["feature", *keys]

    def work(frame: DataFrame, batch_id: int) -> None:
        counts = f"{output}/counts/micro={batch_id}"
        bucket_counts(frame, edges, names, buckets, small).write.mode("overwrite").parquet(counts)
        own = frame.sparkSession.read.parquet(counts)
        _psi(shares_of(own, names, buckets), expected, keys, small).write.mode("overwrite").parquet(f"{output}/data/micro={batch_id}")

    return _per_batch(stream, output, work)


def total_drift(spark: SparkSession, output: str, expected: DataFrame, keys: Sequence[str], buckets: int = v.PSI_BUCKETS) -> DataFrame:
    """One PSI per feature and key over all micro-batches so far."""
    names = ["feature", *keys]
    counts = _stored(spark, f"{output}/counts")
    total = counts.groupBy(*names).agg(*[F.sum(c).alias(c) for c in counts.columns if c not in names])
    return _psi(shares_of(total, names, buckets), expected, keys, fits_broadcast(expected))


def metrics_stream(stream: DataFrame, ts: str, error: Column, output: str, every: str = "1 hour",
                   late: str = "10 minutes") -> StreamingQuery:
    """Service figures per window, updated as rows arrive; rows later than `late` are dropped.

    Every micro-batch writes the windows it changed; `latest_metrics` reads the newest state.
    """
    counts = window_counts(stream.withWatermark(ts, late), ts, error, every)

    def work(frame: DataFrame, batch_id: int) -> None:
        frame.write.mode("overwrite").parquet(f"{output}/data/micro={batch_id}")

    return _per_batch(counts, output, work, mode="update")


def latest_metrics(spark: SparkSession, output: str) -> DataFrame:
    newest = Window.partitionBy("window_start").orderBy(F.desc("micro"))
    rows = spark.read.option("basePath", f"{output}/data").parquet(f"{output}/data")
    last = rows.withColumn("_age", F.row_number().over(newest)).where("_age = 1").drop("_age", "micro")
    return service_metrics(last)


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str, output: str, late: str = "10 minutes") -> StreamingQuery:
    """Drop repeats of a key arriving within the watermark, such as records sent again after a failure."""
    unique = stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))
    return to_files(unique, output)
