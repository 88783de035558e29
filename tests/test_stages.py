import math

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tidewatch import vocabulary as v
from tidewatch.operators import clean, encode, models
from tidewatch.operators.stages import (
    ColumnDropper, ConstantDropper, IndicatorEncoder, LogColumns, PopulationScaler, RateEncoder, ValueGrouper,
)
from tidewatch.sources.tables import connection_schema


def column(df, name):
    return [r[0] for r in df.select(name).collect()]


def test_log_clips_and_keeps_null(spark):
    df = spark.createDataFrame([(0.0,), (-5.0,), (9.0,), (None,)], "src_bytes double")
    assert column(LogColumns(columns=["src_bytes"]).transform(df), "src_bytes_log") == [0.0, 0.0, math.log1p(9), None]


def test_grouper(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "su_attempted int")
    stage = ValueGrouper()
    assert column(stage.transform(df), "su_attempted_grouped") == [0, 1, 1, 1]
    assert [tuple(r) for r in stage.observed(df.dropna()).collect()] == [(0, False), (1, False), (2, True)]


def test_constant_is_decided_at_fit(spark):
    train = spark.createDataFrame([(1, 0, None), (2, 0, None)], "a int, num_outbound_cmds int, is_host_login int")
    model = ConstantDropper().fit(train)
    assert model.transform(train).columns == ["a"]
    varied = spark.createDataFrame([(1, 0, 0), (2, 5, 0)], "a int, num_outbound_cmds int, is_host_login int")
    kept = ConstantDropper().fit(varied)
    assert kept.transform(varied.limit(1)).columns == ["a", "num_outbound_cmds"]


def test_dropper_reports_missing(spark):
    df = spark.createDataFrame([(1, 2)], "num_root int, x int")
    stage = ColumnDropper()
    assert stage.transform(df).columns == ["x"] and "serror_rate" in stage.missing(df)


def test_rates_come_from_training_rows_only(spark):
    train = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 0)], "service string, is_anomaly int")
    model = RateEncoder().fit(train)
    new = spark.createDataFrame([("a",), ("b",), ("zzz",), (None,)], "service string")
    assert column(model.transform(new), "service_anomaly_rate") == [0.5, 1.0, 0.5, 0.5]


def test_indicators_follow_the_training_values(spark):
    train = spark.createDataFrame([("tcp",), ("udp",)], "protocol_type string")
    model = IndicatorEncoder(columns=["protocol_type"]).fit(train)
    test = spark.createDataFrame([("tcp",), ("icmp",), (None,)], "protocol_type string")
    result = model.transform(test)
    assert result.columns == ["protocol_type_tcp", "protocol_type_udp"]
    assert [tuple(r) for r in result.collect()] == [(1, 0), (0, 0), (0, 0)]


def test_scaler_uses_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 4.0), (3.0, 4.0)], "x double, flat double")
    result = PopulationScaler(columns=["x", "flat"]).fit(df).transform(df)
    assert column(result, "x_scaled") == [-1.0, 1.0] and column(result, "flat_scaled") == [0.0, 0.0]


def test_fitted_pipeline_survives_saving(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "tcp", 5, 1, 0), ("b", "udp", 7, 0, 0), ("a", "tcp", -1, 0, 0)],
        "service string, protocol_type string, src_bytes int, is_anomaly int, num_outbound_cmds int",
    )
    model = Pipeline(stages=[
        LogColumns(columns=["src_bytes"]), ConstantDropper(), RateEncoder(),
        IndicatorEncoder(columns=["protocol_type"]), PopulationScaler(columns=["src_bytes"]),
    ]).fit(df)
    model.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    key = lambda frame: sorted(map(str, frame.collect()))
    assert key(again.transform(df)) == key(model.transform(df))


def test_feature_pipeline_column_count(spark):
    zero = {"string": "tcp", "long": 0, "double": 0.0}
    row = {f.name: zero[f.dataType.typeName()] for f in connection_schema().fields}
    df = spark.createDataFrame([tuple(row.values())], connection_schema()).withColumns({"attack_category": F.lit("dos"), "is_anomaly": F.lit(1)})
    assert len(df.columns) == 44
    result = models.feature_pipeline().fit(df).transform(df)
    assert len(result.columns) == 40
    assert len([c for c in result.columns if c not in v.TARGETS]) == 37


# Rows -----------------------------------------------------------------------------------------


def test_dedup(spark):
    df = spark.createDataFrame([("normal", 1), ("normal", 1), ("dos", 1), ("dos", 1), (None, 2), (None, 2)], "k string, x int")
    once = clean.dedup_global(df)
    assert once.count() == 3 and clean.dedup_global(once).count() == 3
    assert clean.dedup_in_class(df, "k", "normal").count() == 5
    distinct, removed = clean.verified_distinct(df)
    assert (distinct.count(), removed) == (3, 3)


def test_marks_later_copies_only(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, None), (4, None), (5, "b")], "id int, k string")
    marked = {r.id for r in clean.mark_duplicates(df, ["k"], "id").where("is_duplicate").collect()}
    assert marked == {3, 4}


# Split ----------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def events(spark):
    return spark.range(5000).select("id", (F.col("id") % 37 == 0).cast("int").alias("y"), F.lit("x").alias("z"))


def test_split_is_exact_complete_and_stable(events):
    marked = encode.stratified_split(events, "y", ["id"])
    assert marked.count() == 5000
    counts = {(r.y, r.split): r.n for r in marked.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    ones = counts[1, "test"] + counts[1, "train"]
    assert counts[1, "test"] == math.floor(0.2 * ones + 0.5) and counts[0, "test"] == math.floor(0.2 * (5000 - ones) + 0.5)
    again = encode.stratified_split(events.repartition(7), "y", ["id"])
    test = lambda df: {r.id for r in df.where("split = 'test'").collect()}
    assert test(marked) == test(again)
    assert test(marked) != test(encode.stratified_split(events, "y", ["id"], seed=1))


# Records to score -----------------------------------------------------------------------------


def test_partial_record_gets_defaults(spark):
    df = spark.createDataFrame([(0, "tcp", "http", "SF", 215, 45076, 1)],
                               "duration int, protocol_type string, service string, flag string, src_bytes int, dst_bytes int, logged_in int")
    row = encode.prepare_records(df).first().asDict()
    assert row["src_bytes_log"] == pytest.approx(math.log1p(215)) and row["service_anomaly_rate"] == 0.5
    assert row["protocol_type_tcp"] == 1 and row["flag_SF"] == 1 and row["flag_REJ"] == 0 and row["su_attempted_grouped"] == 0
    assert "service" not in row and len([c for c in row if c.startswith("flag_")]) == 11


def test_bad_cells_and_gaps_in_records(spark):
    df = spark.createDataFrame([("x", None, "new", "3"), ("7d", "udp", None, None)],
                               "src_bytes string, protocol_type string, service string, su_attempted string")
    rows = encode.prepare_records(df, expected=["src_bytes", "su_attempted_grouped", "protocol_type_tcp", "protocol_type_udp", "unknown"]).collect()
    assert [tuple(r) for r in rows] == [(0.0, 1, 0, 0, 0), (0.0, 0, 0, 1, 0)]


def test_decision_border(spark):
    df = spark.createDataFrame([(0.5,), (0.49999,), (0.123456,)], "s double")
    rows = encode.decide(df, F.col("s"), "m-1").collect()
    assert [(r.anomaly, r.anomaly_score, r.model_version) for r in rows] == [(True, 0.5, "m-1"), (False, 0.5, "m-1"), (False, 0.1235, "m-1")]
