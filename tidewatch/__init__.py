"""Tidewatch: profiling, gating, cleaning, encoding, modelling, scoring and monitoring of
wide labelled record tables, written as Spark DataFrame, MLlib and Structured Streaming jobs."""
