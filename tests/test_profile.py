import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewatch import vocabulary as v
from tidewatch.operators import explore, gates, profile, targets


@pytest.fixture(scope="module")
def pair(spark):
    random = np.random.default_rng(3)
    n = 800
    frame = pd.DataFrame({
        "a": random.exponential(2, n), "b": random.normal(0, 1, n), "flat": np.full(n, 3.0),
        "c": np.where(random.random(n) < 0.9, 0.0, random.exponential(50, n)),
        "is_anomaly": (random.random(n) < 0.2).astype(int),
    })
    frame["d"] = frame.a * -2 + 0.01 * frame.b
    frame["gaps"] = frame.a.where(frame.index % 4 != 0)
    return frame, spark.createDataFrame(frame.astype(object).where(frame.notna(), None),
                                        "a double, b double, flat double, c double, is_anomaly int, d double, gaps double")


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_nulls_and_totals(pair):
    frame, df = pair
    assert as_dict(profile.null_profile(df), "column", "nulls") == {"gaps": int(frame.gaps.isna().sum())}
    assert profile.total_nulls(df).first()[0] == int(frame.isna().sum().sum())


def test_skewness_like_pandas(pair):
    frame, df = pair
    found = as_dict(profile.skewness(df, limit=None), "feature", "skewness")
    expected = frame.skew()
    for c in frame.columns:
        assert found[c] == pytest.approx(expected[c], abs=1e-9)


def test_outliers_like_pandas(pair):
    frame, df = pair
    found = as_dict(profile.outliers_iqr(df), "feature", "outliers")
    expected = {}
    for c in frame.columns.drop("is_anomaly"):
        q1, q3 = frame[c].quantile([0.25, 0.75])
        if q3 != q1:
            n = int(((frame[c] < q1 - 3 * (q3 - q1)) | (frame[c] > q3 + 3 * (q3 - q1))).sum())
            if n:
                expected[c] = n
    assert found == expected and "c" not in found


def test_outlier_percent_counts_missing_rows(spark):
    df = spark.createDataFrame([(float(i),) for i in range(20)] + [(1e6,)] + [(None,)] * 19, "x double")
    row = profile.outliers_iqr(df).first()
    assert (row.outliers, row.pct) == (1, 2.5)


def test_correlations_like_pandas(pair):
    frame, df = pair
    expected = frame.drop(columns="is_anomaly").corr()
    found = {(r.feature_a, r.feature_b): r.r for r in profile.correlation_pairs(df).collect()}
    assert not any("flat" in p for p in found)
    assert len(found) == 10
    for (a, b), r in found.items():
        assert r == pytest.approx(expected.loc[a, b], abs=1e-9)
    strong = profile.correlated_pairs(df).collect()
    assert {(r.feature_a, r.feature_b) for r in strong} == {("a", "d"), ("a", "gaps"), ("d", "gaps")}


def test_target_correlation_with_constant(pair):
    frame, df = pair
    found = as_dict(profile.target_correlation(df, ["a", "flat", "absent"]), "feature", "r")
    assert found["flat"] is None and "absent" not in found
    assert found["a"] == pytest.approx(frame.a.corr(frame.is_anomaly))


def test_zscore_like_pandas(pair):
    frame, df = pair
    numbers = frame.drop(columns="is_anomaly")
    z = (numbers - numbers.mean()) / numbers.std(ddof=0)
    extreme = (z.abs() > 5).any(axis=1)
    row = profile.zscore_extremes(df, target=F.col("is_anomaly")).first()
    assert row.extreme_rows == int(extreme.sum()) > 0
    assert row.anomaly_overlap == int((extreme & (frame.is_anomaly == 1)).sum())


def test_text_checks(spark):
    df = spark.createDataFrame(
        [("tcp", "SF", "?"), ("TCP", "SF", "none"), (None, "S9", "None"), ("tcp", "SF", None)],
        "protocol_type string, flag string, note string",
    )
    assert as_dict(profile.encoded_missing(df), "column", "tokens") == {"note": 2}
    assert as_dict(profile.cardinality(df), "column", "distinct_values") == {"protocol_type": 2, "flag": 2, "note": 3}
    stray = {(r.column, r.value, r.rows) for r in profile.unexpected_categories(df).collect()}
    assert stray == {("protocol_type", "TCP", 1), ("protocol_type", None, 1), ("flag", "S9", 1)}


def test_approximate_cardinality(spark):
    df = spark.range(2000).select((F.col("id") % 700).cast("string").alias("t"))
    assert profile.cardinality(df, relative_error=0.02).first().distinct_values == pytest.approx(700, rel=0.1)


def test_duplicates_count_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a"), (2, "a"), (1, None)], "x int, y string")
    row = profile.duplicate_profile(df).first()
    assert (row["rows"], row.duplicate_rows, row.duplicate_pct) == (5, 2, 40.0)


def test_record_rules_and_impossible_values(spark):
    df = spark.createDataFrame(
        [(1, 0, 0, 1, 0, 0, 1.2), (1, 1, 0, 1, 5, 0, 0.5), (2, 0, 0, 0, -1, 0, -0.1)],
        "su_attempted int, root_shell int, num_root int, land int, src_bytes int, dst_bytes int, serror_rate double",
    )
    assert as_dict(profile.inconsistent_rows(df), "rule", "rows") == {
        "su_attempted_sin_evidencia_root": 1, "land_attack_sin_bytes": 1}
    assert as_dict(profile.impossible_values(df), "finding", "rows") == {
        "src_bytes_negativos": 1, "serror_rate_fuera_de_[0,1]": 2}


def test_schema_findings(spark):
    df = spark.createDataFrame([("normal.", "x", 1, 0.5, 0)], "label string, attack_category string, count int, dst_host_serror_rate double, is_anomaly int")
    groups = {}
    for r in profile.leakage_inventory(df).collect():
        groups.setdefault(r.finding, []).append(r.column)
    assert groups["features_ventana_2_segundos"] == ["count"]
    assert groups["features_ventana_100_conexiones"] == ["dst_host_serror_rate"]
    assert len(groups["derived_target_columns"]) == 3
    assert [r.column for r in profile.window_columns_kept(df).collect()] == ["count"]
    difference = {(r.column, r.difference) for r in profile.schema_difference(df, ["label", "flag"]).collect()}
    assert ("flag", "missing") in difference and ("count", "unexpected") in difference
    assert profile.static_findings(df).count() == 3
    wrong = {r.column for r in profile.type_profile(df.withColumn("service", F.lit(3))).where("not matches").collect()}
    assert wrong == {"service"}


def test_classes(spark):
    df = spark.createDataFrame([("a",)] * 6 + [("b",)] * 2 + [("c",)] * 2 + [(None,)] * 2, "attack_category string")
    rows = profile.class_distribution(df).collect()
    assert [(r["class"], r.rows, r.pct) for r in rows] == [("a", 6, 50.0), ("b", 2, 16.667), ("c", 2, 16.667)]
    row = profile.class_imbalance(df).first()
    assert (row.majority, row.minority, row.ratio) == ("a", "b", 3.0)


def test_label_taxonomies(spark):
    df = spark.createDataFrame([("smurf.",), ("b'smurf.'",), ("normal.",), ("nmap",), ("new.",)], "label string")
    dotted = targets.pipeline_targets(df).collect()
    assert [r.attack_category for r in dotted] == ["dos", "desconocido", "normal", "desconocido", "desconocido"]
    assert [r.is_anomaly for r in dotted] == [1, 1, 0, 1, 1]
    plain = targets.profile_targets(df).collect()
    assert [r.attack_category for r in plain] == ["dos", "dos", "normal", "probe", "unknown"]
    assert [r.is_anomaly for r in plain] == [1, 1, 0, 1, 1]
    assert len(v.DOTTED_TAXONOMY) == 40 and len(v.PLAIN_TAXONOMY) == 23


def test_gates_stop_at_the_first_failure(spark):
    df = spark.createDataFrame([(i % 2, "x") for i in range(50)], "a int, label string")
    table = gates.gate_table(df, min_rows=10, expected_columns=2)
    assert [(r.gate, r.passed) for r in table.orderBy("position").collect()] == [
        ("not_empty", True), ("minimum_rows", True), ("column_count", True), ("required_columns", True), ("duplicate_rate", False)]
    with pytest.raises(gates.GateFailure, match="duplicate_rate"):
        gates.enforce(table)
    with pytest.raises(gates.GateFailure, match="not_empty"):
        gates.enforce(gates.gate_table(df.limit(0)))
    gates.enforce(gates.gate_table(df, 10, 2, max_duplicate_rate=0.99))


def test_clean_table_rules(spark):
    df = spark.createDataFrame([(0, 1, 2, 1, "a"), (0, -1, 2, 2, None)], "duration int, src_bytes int, dst_bytes int, logged_in int, label string")
    found = as_dict(gates.clean_table_rules(df), "rule", "passed")
    assert found == {"required_columns": True, "no_nulls": False, "numeric_types": True, "non_negative": False, "binary_login": False}


def test_missing_values_break_the_range_rules(spark):
    df = spark.createDataFrame([(0, None, 2, None, "a")], "duration int, src_bytes int, dst_bytes int, logged_in int, label string")
    found = as_dict(gates.clean_table_rules(df), "rule", "passed")
    assert found == {"required_columns": True, "no_nulls": False, "numeric_types": True, "non_negative": False, "binary_login": False}


def test_histogram_like_numpy(spark):
    random = np.random.default_rng(5)
    data = {"tenths": np.round(random.integers(0, 11, 400) / 10, 1), "one": np.full(7, 0.3), "wide": random.exponential(3, 300)}
    df = spark.createDataFrame([(k, float(x)) for k, xs in data.items() for x in xs], "k string, x double")
    rows = explore.histogram_by_class(df, "k", "x").orderBy("class", "bin").collect()
    for k, xs in data.items():
        counts, edges = np.histogram(xs, bins=20)
        density, _ = np.histogram(xs, bins=20, density=True)
        mine = [r for r in rows if r["class"] == k]
        assert [r.rows for r in mine] == counts.tolist()
        assert [r.density for r in mine] == pytest.approx(density)
        assert [r.left_edge for r in mine] == pytest.approx(edges[:-1])


def test_box_whiskers_stay_outside_the_box(spark):
    values = [1.0, 1.0, 1.0, 1.0, 100.0, 2.0, 3.0]
    df = spark.createDataFrame([("k", x) for x in values], "k string, x double")
    row = explore.boxplot_by_class(df, "k", ["x"]).first()
    logged = np.log1p(values)
    q1, q2, q3 = np.quantile(logged, [0.25, 0.5, 0.75])
    inside = logged[logged <= q3 + 1.5 * (q3 - q1)]
    assert (row.q1, row.median, row.q3) == pytest.approx((q1, q2, q3))
    assert row.whisker_high == pytest.approx(max(inside.max(), q3)) and row.whisker_low == pytest.approx(min(logged.min(), q1))


def test_service_risk_needs_support(spark):
    rows = [("hot", 1)] * 60 + [("rare", 1)] * 49 + [("calm", 0)] * 50
    df = spark.createDataFrame(rows, "service string, is_anomaly int")
    assert [r.service for r in explore.service_risk(df).collect()] == ["hot", "calm"]


def test_nan_is_missing_without_a_reader(spark):
    """Operators meet NaN in derived frames too: it is no gap in a rule, no largest value and no poison for sums."""
    nan = float("nan")
    rows = [(float(i % 5), float(i % 5) / 10, i, float(i)) for i in range(20)] + [(nan, nan, 20, 1000.0), (None, 0.1, 21, 3.0)]
    df = spark.createDataFrame(rows, "a double, rate double, i int, big double")
    assert {r["column"]: r.nulls for r in profile.null_profile(df).collect()} == {"a": 2, "rate": 1}
    assert profile.total_nulls(df).first()[0] == 3
    assert profile.impossible_values(df, ["a"], ["rate"]).count() == 0
    assert profile.zscore_extremes(df, ["a", "rate"]).first().extreme_rows == 0
    clean = df.where("NOT isnan(a) AND a IS NOT NULL")
    skew = lambda frame: profile.skewness(frame, ["a"], limit=None).first().skewness
    assert skew(df) == pytest.approx(skew(clean))
    found = {(r.feature_a, r.feature_b): r.r for r in profile.correlation_pairs(df).collect()}
    both = df.where("NOT isnan(a) AND NOT isnan(rate) AND a IS NOT NULL").toPandas()
    assert found["a", "rate"] == pytest.approx(both["a"].corr(both["rate"]))
    assert found["a", "big"] == pytest.approx(both["a"].corr(both["big"]))


def test_correlations_need_one_pass(spark, tmp_path):
    """Many columns with gaps: as pandas has it, and the data is read by one job (and its first rows by another)."""
    import numpy as np
    import pandas as pd

    draw = np.random.default_rng(5)
    data = pd.DataFrame(draw.normal(1e6, 1, (400, 14)).cumsum(axis=1), columns=[f"c{i}" for i in range(14)])
    data = data.mask(draw.random(data.shape) < 0.2)
    data["flat"] = 7.0
    data["rare"] = np.where(np.arange(400) < 2, 1.0, np.nan)
    path = str(tmp_path / "wide")
    spark.createDataFrame(data.astype(object).where(data.notna(), None), ", ".join(f"{c} double" for c in data.columns)).repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    spark.sparkContext.setJobGroup("pairs", "correlation")
    rows = {(r.feature_a, r.feature_b): r.r for r in profile.correlation_pairs(df).collect()}
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("pairs")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 5
    want = data.corr()
    names = [c for c in data.columns if c not in ("flat", "rare")]
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            assert rows[a, b] == pytest.approx(want.loc[a, b], abs=1e-9)
    assert not any("flat" in p or "rare" in p for p in rows)
