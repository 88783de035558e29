import pytest
from pyspark.sql import functions as F

from tidewatch.operators.batches import batch_incidents, batch_verdict, counted_verdict, route
from tidewatch.operators.service import service_metrics

EXPECTED = {"duration": "numeric", "protocol_type": "categorical", "src_bytes": "numeric", "dst_bytes": "numeric", "count": "numeric"}
SCHEMA = "row_id int, batch string, duration string, protocol_type string, src_bytes string, dst_bytes string, count string, unexpected_column string"
DEFECTS = [
    (0, "bad", None, "tcp", "181", "5450", "9", "anomaly_data"),
    (1, "bad", "2", "udp", "239", "486", "19", "anomaly_data"),
    (2, "bad", "0", "tcp", "-999999", "1337", "2", "anomaly_data"),
    (3, "bad", "5", "icmp", "0", "0", "tres", "anomaly_data"),
    (4, "bad", "1", "UNKNOWN_PROTOCOL", "215", "2050", "5", "anomaly_data"),
    (5, "bad", "2", "udp", "239", "486", "19", "anomaly_data"),
]


def test_published_batch(spark):
    df = spark.createDataFrame(DEFECTS, SCHEMA)
    found = batch_incidents(df, EXPECTED, "row_id", "batch")
    assert {(r.type, r.severity, r.detail) for r in found.collect()} == {
        ("SCHEMA_MODIFICATION", "MEDIUM", "Columnas inesperadas: ['unexpected_column']"),
        ("DUPLICATED_ROWS", "LOW", "Se encontraron 1 filas duplicadas"),
        ("MISSING_VALUES", "MEDIUM", "Columna 'duration' tiene 1 valores nulos"),
        ("UNKNOWN_CATEGORY", "HIGH", "Fila 4, 'protocol_type' contiene categoría no registrada: UNKNOWN_PROTOCOL"),
        ("EXTREME_OUTLIER", "HIGH", "Fila 2, 'src_bytes' con valor fuera de rango: -999999"),
        ("INCORRECT_DATATYPE", "HIGH", "Fila 3, 'count' esperaba tipo numérico pero recibió: tres"),
    }
    verdict = batch_verdict(df, found, "batch").first()
    assert (verdict.status, verdict.action, verdict.total_incidents) == ("FAILED", "BLOCKED_BATCH", 6)


def test_verdicts_by_counting_are_those_of_the_incidents(spark):
    clean = [(10 + i, "good", "1", "tcp", "1", str(i), "1", "x") for i in range(3)]
    nothing = [(20, None, "1", "tcp", "1", "1", "1", None), (21, None, None, "udp", "nan", "1_0", "1", None)]
    df = spark.createDataFrame(DEFECTS + clean + nothing, SCHEMA)
    numbers = df.withColumn("src_bytes", F.col("src_bytes").try_cast("double"))
    for frame in (df, numbers, df.drop("unexpected_column"), df.drop("count")):
        want = batch_verdict(frame, batch_incidents(frame, EXPECTED, "row_id", "batch"), "batch")
        assert sorted(map(str, counted_verdict(frame, EXPECTED, "row_id", "batch").collect())) == sorted(map(str, want.collect()))
    plan = batch_incidents(numbers.select("row_id", "batch", "src_bytes"), {"src_bytes": "numeric"}, "row_id", "batch")._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan.upper()


def test_several_batches_and_routing(spark):
    clean = [(10 + i, "good", "1", "tcp", "1", str(i), "1") for i in range(3)]
    rows = [r[:-1] for r in DEFECTS] + clean
    df = spark.createDataFrame(rows, SCHEMA.rsplit(",", 1)[0])
    found = batch_incidents(df, EXPECTED, "row_id", "batch")
    verdict = batch_verdict(df, found, "batch")
    assert {(r.batch, r.action, r.total_incidents) for r in verdict.collect()} == {("bad", "BLOCKED_BATCH", 5), ("good", "WARNED_BATCH", 0)}
    accepted, quarantine = route(df, verdict, "batch")
    assert {r.row_id for r in accepted.collect()} == {10, 11, 12}
    assert quarantine.count() == 6 and accepted.columns == df.columns


@pytest.mark.parametrize("cell, kind", [
    ("nan", None), ("inf", "EXTREME_OUTLIER"), ("1_000", None), (" 7 ", None), ("5d", "INCORRECT_DATATYPE"),
    ("1e3", None), ("100000", None), ("100000.5", "EXTREME_OUTLIER"), ("-0.1", "EXTREME_OUTLIER"), ("", "INCORRECT_DATATYPE"), ("_1", "INCORRECT_DATATYPE"),
])
def test_number_texts(spark, cell, kind):
    df = spark.createDataFrame([(1, "b", cell)], "row_id int, batch string, x string")
    found = [r.type for r in batch_incidents(df, {"x": "numeric"}, "row_id", "batch").collect()]
    assert found == ([kind] if kind else [])


def test_missing_column_blocks(spark):
    df = spark.createDataFrame([(1, "b", "1")], "row_id int, batch string, x string")
    found = batch_incidents(df, {"x": "numeric", "y": "numeric"}, "row_id", "batch")
    assert [(r.type, r.detail) for r in found.collect()] == [("SCHEMA_ERROR", "Columnas faltantes: ['y']")]
    assert batch_verdict(df, found, "batch").first().status == "FAILED"


def test_service_figures(spark):
    df = spark.createDataFrame([(1000, 2, 10.0), (0, 0, 5.0), (4, 1, 0.0)], "request_count long, error_count long, elapsed double")
    rows = [tuple(r)[3:] for r in service_metrics(df).collect()]
    assert rows == [(10.0, 100.0, 0.002, 0.998), (0.0, 0.0, 0.0, 1.0), (0.0, 0.0, 0.25, 0.75)]
