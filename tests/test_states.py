"""Stored states merge to the figures of all rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions.scalars import long_form
from tidewatch.operators import profile, states


@pytest.fixture(scope="module")
def df(spark):
    draw = np.random.default_rng(2)
    rows = [(int(d), float(x), float(y) if i % 9 else None, 7.0, None) for i, (d, x, y) in enumerate(zip(draw.integers(0, 6, 3000), draw.exponential(3, 3000) + 1e6, draw.integers(0, 40, 3000)))]
    return spark.createDataFrame(rows, "day int, x double, y double, flat double, none double")


NAMES = ["x", "y", "flat", "none"]


def test_merged_states_are_those_of_all_rows(spark, df, tmp_path):
    folder = str(tmp_path / "states")
    for day in range(6):
        states.add_part(states.column_states(df.where(F.col("day") == day), NAMES, "day"), folder)
    stored = states.read_states(spark, folder)
    found = {r.feature: r for r in states.profile(states.merged(stored)).collect()}
    pandas = df.toPandas()
    for c in ("x", "y", "flat"):
        values = pandas[c].dropna()
        r = found[c]
        assert (r.n, r.missing, r.low, r.high) == (len(values), 3000 - len(values), values.min(), values.max())
        assert r["mean"] == pytest.approx(values.mean()) and r["std"] == pytest.approx(values.std(ddof=0), abs=1e-9)
        assert r.skewness == pytest.approx(values.skew(), abs=1e-6)
        assert r.distinct_values == pytest.approx(values.nunique(), rel=0.1)
    assert (found["none"].n, found["none"].missing, found["none"]["mean"]) == (0, 3000, None)
    # Weeks of states, or one state over all rows: the same profile.
    whole = {r.feature: r for r in states.profile(states.merged(states.column_states(df.withColumn("all", F.lit(1)), NAMES, "all"))).collect()}
    for c in ("x", "y"):
        assert found[c].skewness == pytest.approx(whole[c].skewness, abs=1e-6) and found[c].skewness == pytest.approx(profile.skewness(df, [c], limit=None).first().skewness, abs=1e-6)


def test_a_part_written_again_replaces_itself(spark, df, tmp_path):
    folder = str(tmp_path / "states")
    for day in (0, 1, 1):
        states.add_part(states.column_states(df.where(F.col("day") == day), ["x"], "day"), folder)
    assert states.merged(states.read_states(spark, folder)).first().n == df.where("day < 2").count()


def test_ranks_are_within_the_stated_error(spark, df):
    merged = states.merged(states.column_states(df, NAMES, "day"))
    gaps = states.rank_gaps(merged, long_form(df, NAMES), [0.01, 0.25, 0.5, 0.75, 0.99]).collect()
    assert len(gaps) == 15 and max(r.gap for r in gaps) <= 2 * states.RANK_ERROR
    bounds = {r.feature: r for r in states.outlier_bounds(merged).collect()}
    assert bounds["flat"].lower == bounds["flat"].upper == 7.0 and bounds["none"].lower is None
