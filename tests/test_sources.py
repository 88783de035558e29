from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidewatch.sources import runlog, tables


def test_csv_by_name_without_inference(spark, tmp_path):
    path = str(tmp_path / "raw.csv")
    (tmp_path / "raw.csv").write_text("src_bytes,label,duration\n5,normal.,x\n,smurf.,2\n")
    df = tables.read_csv(spark, path, tables.connection_schema())
    assert df.dtypes == [("src_bytes", "bigint"), ("label", "string"), ("duration", "bigint")]
    assert [tuple(r) for r in df.collect()] == [(5, "normal.", None), (None, "smurf.", 2)]
    assert {t for _, t in tables.read_csv(spark, path).dtypes} == {"string"}


def test_missing_source(spark, tmp_path):
    for read in (tables.read_csv, tables.read_parquet):
        with pytest.raises(tables.MissingSource):
            read(spark, str(tmp_path / "nowhere"))


def test_normalise_raw(spark):
    df = spark.createDataFrame([(bytearray("normal.".encode()), bytearray("ñandú".encode()), 1)], "target binary, service binary, x int")
    assert tables.normalise_raw(df).first().asDict() == {"label": "normal.", "service": "ñandú", "x": 1}
    other = spark.createDataFrame([("a",)], "labels string")
    assert tables.normalise_raw(other).columns == ["label"]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r.x for r in tables.nan_to_null(df).collect()] == [None, 1.0]


def test_parquet_keeps_float_digits(spark, tmp_path):
    df = spark.createDataFrame([(0.1 + 0.2,), (1 / 3,)], "x double")
    tables.write_table(df, str(tmp_path / "t"))
    assert sorted(r.x for r in tables.read_parquet(spark, str(tmp_path / "t")).collect()) == sorted([0.1 + 0.2, 1 / 3])
    tables.write_table(df, str(tmp_path / "c"), "csv")
    assert spark.read.csv(str(tmp_path / "c"), header=True).count() == 2


def test_report_by_check(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "check string, value double")
    tables.write_report(df, str(tmp_path / "report"))
    assert {r.check for r in spark.read.json(str(tmp_path / "report")).collect()} == {"a", "b"}


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 3 == 0, None).otherwise("x").alias("t"))
    for portable in (False, True):
        one = runlog.table_fingerprint(df, portable).first()
        assert one == runlog.table_fingerprint(df.orderBy(F.desc("id")).repartition(9), portable).first()
        assert one != runlog.table_fingerprint(df.withColumn("t", F.coalesce("t", F.lit(""))), portable).first()
        assert one != runlog.table_fingerprint(df.union(df.limit(1)), portable).first()


def test_run_log_is_idempotent(spark, tmp_path):
    metrics = spark.createDataFrame([("auc", 0.9), ("f1", 0.8)], "metric string, value double")
    run = lambda name, mark: runlog.report_row(metrics, name, "GBT", {"rounds": 100, "depths": [1, 2], "w": {"a": 1.5}}, mark)
    path = str(tmp_path / "log")
    for _ in range(2):
        runlog.append_runs(path, run("first", "f1"))
        runlog.append_runs(path, run("second", "f2"))
    rows = spark.read.parquet(path).collect()
    assert sorted(r.run_name for r in rows) == ["first", "second"]
    assert rows[0].metrics == {"auc": 0.9, "f1": 0.8} and '"depths":"[1,2]"' in rows[0].parameters


def test_every_csv_line_is_kept(spark, tmp_path):
    """Too many and too few cells go to the quarantine, with their text; quotes and gaps are no fault."""
    lines = ["a,b", "1,2", "3,4,5", "6", ",", '"x, y",7', "", "8,n/a", '9,"10', "11,12,", "z"]
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "one.csv").write_text("\n".join(lines) + "\n")
    (tmp_path / "raw" / "two.csv").write_text("a,b\n13,14\n15,16,17\n")
    schema = tables.T.StructType([tables.T.StructField("a", tables.T.StringType()), tables.T.StructField("b", tables.T.LongType())])
    table, quarantine = tables.read_csv_checked(spark, str(tmp_path / "raw"), schema, "bad")
    kept = sorted(((r.a, r.b, r.bad) for r in table.collect()), key=str)
    stray = sorted(r.line for r in quarantine.collect())
    assert ("1", 2, None) in kept and ("13", 14, None) in kept and ("x, y", 7, None) in kept and ("8", None, {"b": "n/a"}) in kept and (None, None, None) in kept
    assert stray == sorted(["3,4,5", "6", "11,12,", "z", "15,16,17"])
    assert len(kept) + len(stray) == sum(bool(x) for x in lines[1:]) + 2
    assert {r.expected for r in quarantine.collect()} == {2} and quarantine.select("line").count() == 5
    sound, none = tables.read_csv_checked(spark, str(tmp_path / "raw" / "two.csv"))
    assert sound.count() == 1 and [tuple(r)[1:] for r in none.collect()] == [("15,16,17", 2)]


def test_writers_at_the_same_time_leave_one_row(spark, tmp_path):
    """Neither sees the other: both attempts are stored, and every reader settles for the same one."""
    path = str(tmp_path / "log")
    runs = lambda name, status="FINISHED": spark.createDataFrame([(name, "f1", status), (name, f"own of {name}", status)], "run_name string, fingerprint string, status string")
    with ThreadPoolExecutor(3) as writers:
        list(writers.map(lambda n: runlog.append_runs(path, runs(n), n), ["a", "b", "c"]))
    first = sorted(map(tuple, runlog.read_runs(path, spark).collect()))
    assert sorted(f for _, f, _ in first) == ["f1", "own of a", "own of b", "own of c"]
    assert sorted(map(tuple, runlog.read_runs(path, spark).collect())) == first
    # A retried call keeps what it wrote; another one adds nothing; failed runs stay as often as they were logged.
    runlog.append_runs(path, runs("b"), "b")
    runlog.append_runs(path, runs("a"))
    assert sorted(f for _, f, _ in map(tuple, runlog.read_runs(path, spark).collect())) == ["f1", "own of a", "own of b", "own of c"]
    for _ in range(2):
        runlog.append_runs(path, runs("x", "FAILED"))
    assert runlog.read_runs(path, spark).where("status = 'FAILED'").count() == 2
