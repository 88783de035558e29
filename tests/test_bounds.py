"""No caps, bounded cells, linear windows, NaN and bad cells at the source."""

import time

from pyspark.sql import functions as F

from tidewatch.functions import joins, ranks
from tidewatch.operators import behaviour, encode, explore
from tidewatch.operators.stages import sparse_indicators
from tidewatch.sources import tables


def test_many_categories(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("c"), (F.col("id") % 2).cast("string").alias("k"))
    assert explore.crosstab_pct(df, "k", "c").count() == 40_000
    row = sparse_indicators(["c"]).fit(df).transform(df).select("c_vector").first()
    assert row.c_vector.size == 20_001 and row.c_vector.numNonzeros() == 1


def test_cells_hold_the_bound_in_spite_of_ties(spark, monkeypatch):
    monkeypatch.setattr(ranks, "TASK_ROWS", 100)
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 7.0).otherwise(F.col("id").cast("double")).alias("x"))
    counts, keys = ranks.cell_counts(df, "x", {"n": F.lit(1)})
    largest = counts.groupBy(*keys, "_cell").count().agg(F.max("count")).first()[0]
    assert largest <= 100
    assert counts.agg(F.sum("n")).first()[0] == 20_000


def test_a_share_that_takes_the_whole_stratum(spark):
    df = spark.range(3).withColumn("y", F.lit("a"))
    sides = encode.stratified_split(df, "y", ["id"], test_share=0.9)
    assert sides.where("split = 'test'").count() == 3


def test_long_texts_are_not_broadcast(spark):
    wide = spark.range(30).select(F.repeat(F.lit("x"), 1_000_000).alias("t"))
    assert not joins.fits_broadcast(wide) and joins.fits_broadcast(wide.select(F.substring("t", 1, 5).alias("t")))


def test_dense_key_window(spark):
    rows = spark.range(40_000).select(
        F.col("id").alias("i"), F.lit("h").alias("host"), F.lit("s").alias("service"), F.timestamp_micros(F.col("id") * 50).alias("ts"))
    begun = time.time()
    last = behaviour.two_second_features(rows, "host", "service", "ts").where("i = 39999").first()
    assert last["count"] == 40_000 and last["srv_count"] == 40_000
    assert time.time() - begun < 60


def test_bad_cells_are_kept(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("duration,label\nx,a\nNaN,b\n3,c\n")
    df = tables.read_csv(spark, str(tmp_path / "raw.csv"), tables.connection_schema(), bad_cells="bad")
    assert [(r.duration, r.bad) for r in df.collect()] == [(None, {"duration": "x"}), (None, {"duration": "NaN"}), (3, None)]
