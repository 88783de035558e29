"""Session settings used by tests, the benchmark and local runs.

A cluster session comes from `spark-submit`; the only settings the library relies on are
adaptive execution, a UTC time zone and `spark.checkpoint.dir` on shared storage.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: str | int = 8, name: str = "tidewatch", **settings: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
