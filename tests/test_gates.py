"""Gates gathered while writing, stops inside plans, and duplicates by address."""

import pytest
from pyspark.sql import functions as F

from tidewatch.operators import clean, gates
from tidewatch.plans.catalogue import QUERIES
from tidewatch.sources import tables


def marked(spark):
    return spark.range(1000).select((F.col("id") % 300).alias("x"), F.when(F.col("id") % 300 == 7, None).otherwise("a").alias("label"),
                                    F.when(F.col("id") % 300 < 60, "test").otherwise("train").alias("split"), (F.col("id") % 300 % 5 == 0).cast("int").alias("y"))


def test_gates_of_a_write_are_those_of_the_table(spark, tmp_path):
    df = marked(spark)
    wanted = dict(min_rows=500, expected_columns=4, required=["label", "absent"], max_duplicate_rate=0.5)
    spark.sparkContext.setJobGroup("write", "observed")
    found, facts = gates.write_distinct(spark, marked, str(tmp_path / "out"), "split", "y", **wanted)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("write"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 3  # the write's own stages under adaptive execution, and nothing else
    assert found.collect() == gates.gate_table(df, **wanted).collect()
    stored = tables.read_parquet(spark, str(tmp_path / "out"))
    assert stored.count() == 300
    assert {(r.fact, r.key): r.value for r in facts.collect()} == {
        ("total_null_cells", None): 1.0, ("rows", "train"): 240.0, ("rows", "test"): 60.0, ("anomaly_share", "train"): 0.2, ("anomaly_share", "test"): 0.2}


def test_an_empty_write_fails_its_gates(spark, tmp_path):
    found, _ = gates.write_distinct(spark, lambda session: marked(session).limit(0), str(tmp_path / "out"))
    assert [r.passed for r in found.orderBy("position").collect()] == [False, False, False, True, False]


def test_a_table_stops_at_a_bad_row_and_at_a_gate(spark):
    df = marked(spark).select("x", "label")
    rules = {"small": F.col("x") < 300, "named": F.col("label").isNotNull()}
    with pytest.raises(Exception, match="rules broken: named"):
        gates.guarded(df, rules).agg(F.sum("x")).collect()
    assert gates.guarded(df.where("x <> 7"), rules).count() == df.where("x <> 7").count()
    late = gates.only_past(df, gates.gate_table(df, min_rows=2000, expected_columns=2))
    with pytest.raises(Exception, match="gate minimum_rows failed: observed 1000.0, threshold 2000.0"):
        late.groupBy("label").count().collect()
    assert gates.only_past(df, gates.gate_table(df, min_rows=1000, expected_columns=2)).count() == 1000


def test_a_stream_stops_at_a_bad_row(spark, tmp_path):
    df = marked(spark).select("x", "label")
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    df.where("x < 5").coalesce(1).write.mode("append").parquet(folder)
    df.where("x = 7").coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    safe = gates.guarded(stream, {"named": F.col("label").isNotNull()})
    query = safe.writeStream.format("parquet").option("checkpointLocation", f"{output}/_progress").option("path", f"{output}/data").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="rules broken: named"):
        query.awaitTermination()
    assert spark.read.parquet(f"{output}/data").where("x >= 5").count() == 0


def test_duplicates_of_files_by_address(spark, tmp_path):
    """First rows over several files and blocks; only digests and addresses are shuffled."""
    rows = spark.range(70_000).select(F.concat(F.lit("text "), F.col("id") % 40_000).alias("t"), F.when(F.col("id") % 11 > 0, F.col("id") % 7).alias("k"), "id")
    path = str(tmp_path / "rows")
    rows.coalesce(1).write.parquet(path)
    rows.where("id < 100").repartition(2).write.mode("append").parquet(path)
    scan = spark.read.parquet(path)
    found = clean.dedup_files(scan, ["t", "k"])
    assert found.columns == scan.columns
    assert found.select("t", "k").exceptAll(rows.select("t", "k").distinct()).count() == 0 and found.count() == rows.select("t", "k").distinct().count()
    plan = clean.first_rows(scan, ["t", "k"])._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert exchanges and "BroadcastExchange" in found._jdf.queryExecution().executedPlan().toString()
    text_out = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text_out
    assert clean.dedup_files(scan).count() == scan.distinct().count()


@pytest.mark.parametrize("name", ["dedup_global", "gates_while_writing", "guarded_rows"])
def test_queries_shuffle_no_texts(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(text" not in plan
