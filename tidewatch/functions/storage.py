"""Shared storage: where lineage is cut and where streaming jobs keep their output."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach: `spark.checkpoint.dir`.

    Only a local[*] session without that setting gets a temporary folder; on a cluster a
    missing setting is an error, because a machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if configured is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
            configured = tempfile.mkdtemp(prefix="tidewatch-")
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute once, keep as Parquet on shared storage, drop the lineage; readers prune columns.

    Used for small fitted results that later steps read more than once (quantile sketches,
    bucket edges, lookup tables), so that every reader sees the very same values even when
    a lost executor forces part of the job to run again.
    """
    path = fresh_folder(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
