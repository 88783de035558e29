"""Operating figures of a service: latency, throughput, error rate, availability."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.scalars import ratio_or_zero


def service_metrics(df: DataFrame, requests: str = "request_count", errors: str = "error_count", elapsed: str = "elapsed") -> DataFrame:
    """Add the four figures; zero requests or zero seconds give 0, not an error."""
    n, bad, seconds = F.col(requests), F.col(errors), F.col(elapsed)
    error_rate = F.when(n > 0, ratio_or_zero(bad, n)).otherwise(0.0)
    throughput = F.when(seconds > 0, ratio_or_zero(n, seconds)).otherwise(0.0)
    latency = F.when(n > 0, ratio_or_zero(seconds, n) * 1000).otherwise(0.0)
    return df.withColumns({
        "latency_ms_per_req": F.round(latency, 2),
        "throughput_req_per_sec": F.round(throughput, 2),
        "error_rate": F.round(error_rate, 4),
        "availability": F.round(1.0 - error_rate, 4),
    })


def window_counts(df: DataFrame, ts: str, error: Column, every: str = "1 hour") -> DataFrame:
    """Requests and errors per tumbling window; works on a table and on a stream."""
    return (
        df.withColumn("_error", error).groupBy(F.window(ts, every).alias("_window"))
        .agg(F.count("*").alias("request_count"), F.count_if("_error").alias("error_count"))
        .select(
            F.col("_window.start").alias("window_start"), "request_count", "error_count",
            (F.unix_timestamp("_window.end") - F.unix_timestamp("_window.start")).cast("double").alias("elapsed"),
        )
    )
