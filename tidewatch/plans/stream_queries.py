"""Queries: the streaming jobs run over a table with availableNow; their SQL is the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewatch.functions.scalars import long_form
from tidewatch.functions.storage import fresh_folder
from tidewatch.operators import drift
from tidewatch.operators.encode import linear_score
from tidewatch.plans import monitoring_queries as batch
from tidewatch.plans.registry import query, shown
from tidewatch.sources import views
from tidewatch.sources.tables import read_table
from tidewatch.streaming import behaviour, jobs

#: Micro-batches of the jobs whose groups reach over several of them.
PARTS = 4


def _events(spark, folder):
    schema = read_table(spark, folder, "events").schema
    return jobs.file_stream(spark, folder, schema, "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def _events_in_parts(spark, folder, files=PARTS):
    """The events as several files, dealt to PARTS micro-batches."""
    parts = fresh_folder(spark, "parts")
    spark.read.parquet(f"{folder}/events.parquet").repartition(files).write.parquet(parts)
    stream = jobs.file_stream(spark, parts, read_table(spark, folder, "events").schema, files=-(-files // PARTS))
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _finish(running):
    running.awaitTermination()


@query("stream_score", """
    SELECT event_id, 1 / (1 + exp(-(0.02 * value - 1))) >= 0.5 AS anomaly, round(1 / (1 + exp(-(0.02::DOUBLE * value - 1))), 4) AS anomaly_score,
           'linear-2' AS model_version
    FROM events""")
def stream_score(spark, folder):
    output = fresh_folder(spark, "score")
    score = linear_score({"value": 0.02}, -1.0)
    _finish(jobs.score_stream(_events(spark, folder), lambda df: df, score, "linear-2", ["event_id"], output))
    return spark.read.parquet(f"{output}/data")


@query("stream_nan", """
    SELECT event_id, event_id % 50 <> 0 AND 1 / (1 + exp(-(0.02 * value - 1))) >= 0.5 AS anomaly,
           round(1 / (1 + exp(-(CASE WHEN event_id % 50 = 0 THEN 0 ELSE 0.02::DOUBLE * value END - 1))), 4) AS anomaly_score FROM events""")
def stream_nan(spark, folder):
    """A stream over files with NaN scores them as missing (0), as the batch readers do."""
    parts, output = fresh_folder(spark, "nan"), fresh_folder(spark, "score")
    nan = F.when(F.col("event_id") % 50 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    events = read_table(spark, folder, "events").select("event_id", nan.alias("value"))
    events.write.parquet(parts)
    stream = jobs.file_stream(spark, parts, events.schema)
    prepare = lambda df: df.withColumn("value", F.coalesce("value", F.lit(0.0)))
    _finish(jobs.score_stream(stream, prepare, linear_score({"value": 0.02}, -1.0), "linear-2", ["event_id"], output))
    return spark.read.parquet(f"{output}/data").select("event_id", "anomaly", "anomaly_score")


@query("stream_gate", batch._INCIDENTS)
def stream_gate(spark, folder):
    output = fresh_folder(spark, "gate")
    rows = batch.event_batches(_events_in_parts(spark, folder))
    _finish(jobs.gate_stream(rows, batch.EXPECTED_FIELDS, "event_id", "batch", output, batch.KINDS, batch.AMOUNTS))
    return jobs.gate_results(spark, output, batch.EXPECTED_FIELDS, "event_id", "batch")["incidents"]


@query("stream_gate_route", f"""
    SELECT 'verdict' AS part, NULL AS event_id, batch, NULL AS amount, NULL AS kind, NULL AS extra, concat(status, ' ', action, ' ', total_incidents) AS told
    FROM ({batch._VERDICT.format(batch._FEED, batch._FEED_INCIDENTS)})
    UNION ALL SELECT CASE WHEN status = 'FAILED' THEN 'quarantine' ELSE 'accepted' END, event_id, batch, amount, kind, extra, NULL
    FROM {batch._FEED} JOIN ({batch._VERDICT.format(batch._FEED, batch._FEED_INCIDENTS)}) USING (batch)""")
def stream_gate_route(spark, folder):
    """The other three outputs of the gate on a stream: verdicts, accepted rows and quarantine, all columns."""
    output = fresh_folder(spark, "gate")
    rows = batch.event_feed(_events_in_parts(spark, folder))
    _finish(jobs.gate_stream(rows, batch.FEED_FIELDS, "event_id", "batch", output, batch.KINDS, batch.AMOUNTS))
    found = jobs.gate_results(spark, output, batch.FEED_FIELDS, "event_id", "batch")
    told = found["verdict"].select(F.lit("verdict").alias("part"), "batch", F.concat_ws(" ", "status", "action", "total_incidents").alias("told"))
    mark = lambda part: found[part].select(F.lit(part).alias("part"), "event_id", "batch", "amount", "kind", "extra")
    return mark("accepted").unionByName(mark("quarantine")).unionByName(told, allowMissingColumns=True)


@query("stream_drift", f"""
    SELECT feature, week, round(psi, 6) AS psi, {batch._STATUS.format('ALERT')} FROM ({batch.psi_sql(batch._FIRST_WEEK, batch._LONG_EVENTS, ["week"])})""")
def stream_drift(spark, folder):
    output = fresh_folder(spark, "drift")
    features = ["value", "user_id"]
    reference = long_form(views.events(spark, folder).where(F.dayofmonth("ts") <= 7), features)
    edges = drift.reference_edges(reference)
    expected = drift.bucket_shares(reference, edges, ["feature"])
    weekly = _events_in_parts(spark, folder).withColumn("week", F.floor((F.dayofmonth("ts") - 1) / 7))
    _finish(jobs.drift_stream(long_form(weekly, features, keep=["week"]), edges, expected, ["week"], output))
    return shown(jobs.total_drift(spark, output, expected, ["week"]))


@query("stream_metrics", batch.HOURLY_SQL)
def stream_metrics(spark, folder):
    output = fresh_folder(spark, "metrics")
    _finish(jobs.metrics_stream(_events(spark, folder), "ts", F.col("event_type") == "error", output))
    return batch.as_text(jobs.latest_metrics(spark, output), "window_start")


@query("stream_dedup", "SELECT DISTINCT event_id, event_type, user_id FROM events")
def stream_dedup(spark, folder):
    """Every event arrives twice; one copy of each leaves."""
    output = fresh_folder(spark, "dedup")
    twice = _events(spark, folder).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    _finish(jobs.dedup_stream(twice, ["event_id"], "ts", output))
    return spark.read.parquet(f"{output}/data").select("event_id", "event_type", "user_id")


#: Longest delay of an event on its way into `stream_behaviour`; the watermark waits as long.
DELAY_SECONDS = 7200
#: Rows of an arriving file, at least.
FILE_ROWS = 200_000


def _delayed_events(spark, folder):
    """Events in PARTS groups of files in the order in which they arrive, each up to DELAY_SECONDS late."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(DELAY_SECONDS * 1_000_000))
    arriving = events.withColumn("_arrival", arrival)
    cuts = arriving.agg(F.percentile_approx("_arrival", [k / PARTS for k in range(1, PARTS)])).first()[0]
    inside = [(F.lit(True) if low is None else F.col("_arrival") > low) & (F.lit(True) if high is None else F.col("_arrival") <= high)
              for low, high in zip([None, *cuts], [*cuts, None])]
    # A group is as many files as any other, so that each makes one micro-batch: with FILE_ROWS rows for each file none is empty.
    files = max(1, min(arriving.agg(*[F.count(F.when(part, 1)) for part in inside]).first()) // FILE_ROWS)
    parts = fresh_folder(spark, "arrivals")
    for part in inside:
        group = arriving.where(part).drop("_arrival")
        (group.coalesce(1) if files == 1 else group.repartition(files)).write.option("maxRecordsPerFile", 0).mode("append").parquet(parts)
    stream = jobs.file_stream(spark, parts, read_table(spark, folder, "events").schema, files=files)
    return stream.select("event_id", "user_id", "event_type", "value", F.col("ts").cast("timestamp").alias("ts"))


@query("stream_behaviour", f"""
    SELECT * FROM ({batch._range_sql("3600 SECONDS")}) JOIN ({batch.LAST_SQL}) USING (event_id)""")
def stream_behaviour(spark, folder):
    """The columns at scoring time, from state under a watermark: those of the whole table."""
    output = fresh_folder(spark, "behaviour")
    roles = behaviour.Behaviour("user_id", "event_type", "ts", "event_id", "value > 50", "value < 5", "port", "source", 3600)
    stream = _delayed_events(spark, folder).withColumns({"port": F.col("event_id") % 7, "source": F.col("event_id") % 4})
    _finish(behaviour.behaviour_stream(stream, roles, output, DELAY_SECONDS))
    return shown(behaviour.behaviour_so_far(spark, output, roles).drop("ts", "user_id", "event_type", "value", "port", "source"))
