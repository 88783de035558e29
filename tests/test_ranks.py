import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tidewatch.functions import joins, ranks
from tidewatch.functions.ranks import cell_counts, exact_quantiles, upto

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def quantiles(df):
    rows = exact_quantiles(df, "x", PROBS, ["g"]).collect()
    return {r.g: list(r.quantiles) for r in rows}


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows and one of its values a third of all rows; NULL, NaN and ties included."""
    random = np.random.default_rng(7)
    hot = np.where(random.random(6000) < 0.5, 0.0, random.exponential(5, 6000))
    parts = [("hot", hot), ("cold", random.normal(0, 1, 500)), ("one", np.array([4.5])), ("same", np.full(50, 2.0))]
    frame = pd.DataFrame([(g, float(x)) for g, xs in parts for x in xs], columns=["g", "x"])
    frame = pd.concat([frame, pd.DataFrame({"g": ["hot", None, "cold"], "x": [float("nan"), 1.0, None]})])
    return frame, spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "g string, x double").repartition(5)


def test_matches_numpy(skewed):
    frame, df = skewed
    clean = frame.dropna()
    found = quantiles(df)
    assert set(found) == set(clean.g.unique())
    for g, values in found.items():
        assert values == pytest.approx(np.quantile(clean[clean.g == g].x, PROBS), abs=1e-12)


@pytest.mark.parametrize("task_rows", [1, 40, 1000])
def test_rounds_of_cells_change_nothing(skewed, monkeypatch, task_rows):
    _, df = skewed
    expected = quantiles(df)
    monkeypatch.setattr(ranks, "TASK_ROWS", task_rows)
    assert quantiles(df) == expected


def test_many_groups_path_changes_nothing(skewed, monkeypatch):
    _, df = skewed
    expected = quantiles(df)
    monkeypatch.setattr(ranks, "BROADCAST_ROWS", 1)
    assert quantiles(df) == expected
    monkeypatch.setattr(ranks, "TASK_ROWS", 100)
    assert quantiles(df) == expected


def test_one_value_holding_almost_all_rows(spark, monkeypatch):
    """The copies fill every cell edge; the rare values must still be told apart."""
    monkeypatch.setattr(ranks, "TASK_ROWS", 5)
    xs = [0.0] * 5000 + [1 + i / 7 for i in range(40)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(4)
    probs = [0.5, 0.993, 0.997, 1.0]
    assert list(exact_quantiles(df, "x", probs).first().quantiles) == pytest.approx(np.quantile(xs, probs))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=40))
def test_any_values(spark, values):
    df = spark.createDataFrame([(float(x),) for x in values], "x double")
    row = exact_quantiles(df, "x", PROBS).first()
    assert row.n == len(values)
    assert list(row.quantiles) == pytest.approx(np.quantile(values, PROBS), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("task_rows", [50, 3])
def test_running_counts_over_cells(skewed, monkeypatch, task_rows):
    frame, df = skewed
    monkeypatch.setattr(ranks, "TASK_ROWS", task_rows)
    counts, keys = cell_counts(df, "x", {"n": F.lit(1)}, ["g"])
    per_cell = counts.withColumn("r", upto("n", [*keys, "_cell"], "_x")).groupBy("g", "_cell").agg(
        F.max("r").alias("last"), F.sum("n").alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi")
    ).orderBy("g", "_cell").collect()
    assert all(r["last"] == r.n for r in per_cell)
    hot = [r for r in per_cell if r.g == "hot"]
    assert len(hot) > 3 and all(a.hi < b.lo for a, b in zip(hot, hot[1:]))
    assert sum(r.n for r in hot) == (frame.dropna().g == "hot").sum()


def test_salted_lookup_equals_broadcast(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 1).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v")
    )
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("left", "inner"):
        small = joins.lookup_join(facts, dim, ["k"], how)
        large = joins.lookup_join(facts, dim, ["k"], how, row_bound=5)
        assert sorted(map(str, small.collect())) == sorted(map(str, large.select(*small.columns).collect()))
