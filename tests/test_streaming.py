"""Streams fed file by file give what the batch operators give on the whole table."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.scalars import long_form
from tidewatch.operators import drift
from tidewatch.operators.batches import batch_incidents, batch_verdict, route
from tidewatch.operators.encode import linear_score, prepare_records
from tidewatch.operators.service import service_metrics, window_counts
from tidewatch.streaming import jobs

SCHEMA = "event_id long, ts timestamp, kind string, value double"


@pytest.fixture(scope="module")
def table(spark):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=7 * i), ["ok", "error", "odd"][i % 3], float(i % 17)) for i in range(120)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture()
def stream(spark, table, tmp_path):
    folder = str(tmp_path / "in")
    for part in range(4):
        table.where(F.col("event_id").between(30 * part, 30 * part + 29)).coalesce(1).write.mode("append").parquet(folder)
    source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return source, str(tmp_path / "out")


def rows(df):
    return sorted(map(str, df.collect()))


def test_scores(spark, table, stream):
    source, output = stream
    score = linear_score({"src_bytes": 0.1}, -1.0)
    prepare = lambda df: prepare_records(df.withColumnRenamed("value", "src_bytes"))
    jobs.score_stream(source, prepare, score, "v1", ["event_id"], output).awaitTermination()
    from tidewatch.operators.encode import decide
    expected = decide(prepare(table), score, "v1").select("event_id", "anomaly", "anomaly_score", "model_version")
    assert rows(spark.read.parquet(f"{output}/data")) == rows(expected)


def test_gate(spark, table, stream):
    source, output = stream
    fields = {"value": "numeric", "kind": "categorical"}
    text = lambda df: df.select("event_id", F.col("value").cast("string").alias("value"), "kind")
    jobs.gate_stream(text(source), fields, "event_id", None, output, ["ok", "error"], (0, 15)).awaitTermination()
    whole = batch_incidents(text(table).withColumn("b", F.lit(0)), fields, "event_id", "b", ["ok", "error"], (0, 15))
    found = spark.read.parquet(f"{output}/incidents")
    cells = lambda df: sorted((r.type, r.row_id) for r in df.where("row_id is not null").collect())
    assert cells(found) == cells(whole) and len(cells(found)) > 0
    assert spark.read.parquet(f"{output}/verdict").where("status = 'FAILED'").count() == 4
    assert spark.read.parquet(f"{output}/quarantine").count() == 120


def test_drift_per_micro_batch(spark, table, stream):
    source, output = stream
    reference = long_form(table, ["value"])
    edges = drift.reference_edges(reference)
    jobs.drift_stream(long_form(source, ["value"]), edges, drift.bucket_shares(reference, edges, ["feature"]), [], output).awaitTermination()
    found = {r.micro: r.psi for r in spark.read.parquet(f"{output}/data").collect()}
    for part in range(4):
        piece = long_form(table.where(F.col("event_id").between(30 * part, 30 * part + 29)), ["value"])
        assert any(psi == pytest.approx(drift.psi_long(reference, piece).first().psi) for psi in found.values())
    assert len(found) == 4


def test_metrics_over_several_micro_batches(spark, table, stream):
    source, output = stream
    bad = F.col("kind") == "error"
    jobs.metrics_stream(source, "ts", bad, output, late="30 days").awaitTermination()
    assert rows(jobs.latest_metrics(spark, output)) == rows(service_metrics(window_counts(table, "ts", bad)))


def test_repeats_leave_once(spark, table, stream):
    source, output = stream
    twice = source.withColumn("_n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_n")
    jobs.dedup_stream(twice, ["event_id"], "ts", output, late="30 days").awaitTermination()
    assert rows(spark.read.parquet(f"{output}/data").select("event_id", "kind")) == rows(table.select("event_id", "kind"))


def test_gate_of_batches_in_several_micro_batches(spark, table, stream):
    source, output = stream
    fields = {"value": "numeric", "kind": "categorical"}
    # Copies of a row lie in different files; one bad cell of batch 'a' comes in the last file only.
    batches = lambda df: df.select("event_id", F.when(F.col("event_id") % 2 == 0, "a").otherwise("b").alias("b"),
                                   F.when(F.col("event_id") == 118, "99").when(F.col("event_id") % 5 > 0, "7").alias("value"), F.lit("ok").alias("kind"))
    jobs.gate_stream(batches(source), fields, "event_id", "b", output, ["ok"], (0, 15)).awaitTermination()
    found = jobs.gate_results(spark, output, fields, "event_id", "b")
    whole = batches(table)
    incidents = batch_incidents(whole, fields, "event_id", "b", ["ok"], (0, 15))
    verdict = batch_verdict(whole, incidents, "b")
    accepted, quarantine = route(whole, verdict, "b")
    want = {"incidents": incidents, "verdict": verdict, "accepted": accepted, "quarantine": quarantine}
    assert {k: rows(df.select(*want[k].columns)) for k, df in found.items()} == {k: rows(df) for k, df in want.items()}
    assert accepted.count() == 60 and quarantine.count() == 60


def test_drift_over_several_micro_batches(spark, table, stream):
    source, output = stream
    reference = long_form(table.where("event_id < 50"), ["value"])
    edges = drift.reference_edges(reference)
    expected = drift.bucket_shares(reference, edges, ["feature"])
    jobs.drift_stream(long_form(source, ["value"], keep=["kind"]), edges, expected, ["kind"], output).awaitTermination()
    found = {r.kind: r.psi for r in jobs.total_drift(spark, output, expected, ["kind"]).collect()}
    want = {r.kind: r.psi for r in drift.psi_long(reference, long_form(table, ["value"], keep=["kind"]), ["kind"]).collect()}
    assert len(found) == 3 and found == pytest.approx(want)
