from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.functions.scalars import long_form
from tidewatch.operators import drift


def frame(spark, **columns):
    rows = list(zip(*[[None if x is None else float(x) for x in xs] for xs in columns.values()]))
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns))


def psi_numpy(reference, production, buckets=10):
    edges = np.percentile(reference, np.linspace(0, 100, buckets + 1))
    edges[0] -= 1e-5
    edges[-1] += 1e-5
    shares = []
    for side in (reference, production):
        share = np.histogram(side, bins=edges)[0] / len(side)
        shares.append(np.where(share == 0, 1e-4, share))
    r, p = shares
    return float(np.sum((p - r) * np.log(p / r)))


@pytest.fixture(scope="module")
def samples():
    random = np.random.default_rng(11)
    return {
        "smooth": (random.exponential(2, 1000), random.exponential(4, 1000)),
        "ties": (np.where(random.random(1000) < 0.4, 0, random.normal(3, 1, 1000)), np.where(random.random(1000) < 0.2, 0, random.normal(3, 1, 1000))),
        "outside": (random.normal(0, 1, 1000), random.normal(0, 6, 1000)),
        "constant": (np.full(1000, 5.0), np.where(random.random(1000) < 0.5, 5.0, 6.0)),
    }


def test_psi_like_numpy(spark, samples):
    reference = frame(spark, **{c: s[0] for c, s in samples.items()})
    production = frame(spark, **{c: s[1] for c, s in samples.items()})
    found = {r.feature: r.psi for r in drift.psi_by_feature(reference, production, list(samples)).collect()}
    for c, (r, p) in samples.items():
        assert found[c] == pytest.approx(psi_numpy(r, p), rel=1e-9)


def test_psi_of_itself_and_of_nothing(spark, samples):
    reference = frame(spark, x=samples["ties"][0], y=[None] * 1000)
    assert [r.psi for r in drift.psi_by_feature(reference, reference, ["x"]).collect()] == [pytest.approx(0.0)]
    empty = reference.limit(0)
    assert [r.psi for r in drift.psi_by_feature(reference, empty, ["x"]).collect()] == [0.0]
    assert [r.psi for r in drift.psi_by_feature(reference, reference, ["y"]).collect()] == [0.0]
    assert [r.psi for r in drift.psi_by_feature(reference, reference.drop("x").withColumn("x", F.lit(None).cast("double")), ["x"]).collect()] == [0.0]


def test_psi_does_not_depend_on_layout(spark, samples):
    r, p = (frame(spark, x=s) for s in samples["ties"])
    one = drift.psi_by_feature(r.coalesce(1), p.coalesce(1), ["x"]).first().psi
    many = drift.psi_by_feature(r.repartition(7), p.repartition(5), ["x"]).first().psi
    assert one == many


def test_batches_and_status(spark, samples):
    reference = frame(spark, x=samples["smooth"][0])
    batches = frame(spark, x=samples["smooth"][0]).withColumn("b", F.lit("same")).unionByName(
        frame(spark, x=samples["smooth"][1]).withColumn("b", F.lit("moved")))
    found = {r.b: r for r in drift.psi_by_batch(reference, batches, ["x"], "b").collect()}
    assert found["same"].status == "OK" and found["same"].psi == pytest.approx(0)
    assert found["moved"].psi == pytest.approx(psi_numpy(*samples["smooth"])) and found["moved"].status == "ALERT"


def test_status_borders(spark):
    df = spark.createDataFrame([(0.0999,), (0.1,), (0.2499,), (0.25,)], "psi double")
    assert [r[0] for r in df.select(drift.drift_status(F.col("psi"))).collect()] == ["OK", "WARNING", "WARNING", "ALERT"]


def ks_brute(a, b):
    points = np.unique(np.concatenate([a, b]))
    return max(abs(np.mean(a <= x) - np.mean(b <= x)) for x in points)


def test_ks_statistic(spark, samples):
    names = list(samples)
    reference = frame(spark, **{c: s[0] for c, s in samples.items()})
    production = frame(spark, **{c: s[1][:600] for c, s in samples.items()})
    found = {r.feature: r for r in drift.ks_by_feature(reference, production, names).collect()}
    for c, (r, p) in samples.items():
        assert found[c].ks == pytest.approx(ks_brute(r, p[:600]))
        assert (found[c].n_reference, found[c].n_production) == (1000, 600)
        assert 0 <= found[c].p_value <= 1


def test_ks_over_cells(spark, samples):
    """Many cells: features begin and end inside them, and one of them holds two thirds of all rows."""
    reference = frame(spark, **{c: s[0] for c, s in samples.items()})
    production = frame(spark, **{c: s[1] for c, s in samples.items()})
    long = [long_form(df, list(samples)).unionByName(long_form(df.crossJoin(spark.range(9)), ["smooth"])) for df in (reference, production)]
    found = {r.feature: r.ks for r in drift.ks_long(*long, cells=23).collect()}
    assert found == pytest.approx({c: ks_brute(*s) for c, s in samples.items()})


def every_order(n, m):
    """All gaps D * n * m of the orders of n and m values, with how often each occurs."""
    counts = {}
    for places in combinations(range(n + m), n):
        i = j = widest = 0
        for k in range(n + m):
            i, j = (i + 1, j) if k in places else (i, j + 1)
            widest = max(widest, abs(i * m - j * n))
        counts[widest] = counts.get(widest, 0) + 1
    return counts


def tail_of(spark, cases):
    df = spark.createDataFrame([(float(d), n, m) for d, n, m in cases], "d double, n long, m long")
    return [r[0] for r in df.select(drift.ks_p_value(F.col("d"), F.col("n"), F.col("m"))).collect()]


@pytest.mark.parametrize("n, m", [(1, 1), (1, 6), (4, 5), (5, 5), (3, 7), (8, 4)])
def test_small_samples_by_counting_all_orders(spark, n, m):
    counts = every_order(n, m)
    cases = [(h / (n * m), n, m) for h in sorted(counts)]
    want = [sum(k for g, k in counts.items() if g >= h) / sum(counts.values()) for h in sorted(counts)]
    assert tail_of(spark, cases) == pytest.approx(want, abs=1e-12)


def test_tabulated_p_values(spark):
    """Exact two-sided values of published tables, and the corrected tail beyond."""
    cases = [(4 / 5, 5, 5), (1, 5, 5), (5 / 8, 8, 8), (6 / 8, 8, 8), (1, 3, 4), (0, 5, 5), (0.5, 10, 10), (0.7, 10, 10)]
    assert tail_of(spark, cases) == pytest.approx([0.079365, 0.0079365, 0.087024, 0.018648, 2 / 35, 1.0, 0.167821, 0.012341], abs=2e-6)


@pytest.mark.parametrize("n, m", [(60, 60), (60, 61), (40, 100), (30, 200), (100, 130)])
def test_corrected_tail_is_near_the_exact_one(spark, n, m, monkeypatch):
    """Where both can be had, the correction is nearer to counted paths than the limiting tail at the 5 % point."""
    root, step = np.sqrt(n * m / (n + m)), np.lcm(n, m)
    gap = float(np.ceil(1.3581 / root * step) / step)
    monkeypatch.setattr(drift, "EXACT_PATHS", n * m)
    exact, = tail_of(spark, [(gap, n, m)])
    monkeypatch.setattr(drift, "EXACT_PATHS", 0)
    corrected, none = tail_of(spark, [(gap, n, m), (0, n, m)])
    assert corrected == pytest.approx(exact, abs=0.003) and none == 1.0


def test_kolmogorov_tail_known_values(spark):
    # Tabulated quantiles of the limiting distribution.
    df = spark.createDataFrame([(0.0,), (0.5,), (0.8276,), (1.2238,), (1.3581,), (1.6276,), (9.0,)], "k double")
    found = [r[0] for r in df.select(drift.kolmogorov_tail(F.col("k"))).collect()]
    assert found == pytest.approx([1.0, 0.96394, 0.5, 0.1, 0.05, 0.01, 0.0], abs=2e-4)


def test_ks_with_an_empty_side(spark, samples):
    reference = frame(spark, x=samples["smooth"][0])
    row = drift.drift_table(reference, reference.limit(0), ["x", "absent"]).collect()
    assert len(row) == 1 and row[0].psi == 0.0 and row[0].ks_p_value is None and row[0].status == "OK"


def test_drift_table_alert(spark, samples):
    reference, production = (frame(spark, x=s) for s in samples["outside"])
    row = drift.drift_table(reference, production, ["x"]).first()
    assert row.status == "ALERT (DRIFT DETECTED)" and row.ks_p_value == pytest.approx(0, abs=1e-4)


def test_retraining_policy(spark):
    cases = [(0.02, 0.94, False), (0.27, 0.88, False), (1.46, 0.55, True), (0.05, 0.60, False), (0.25, 0.79, False), (0.26, 0.80, False)]
    df = spark.createDataFrame([c[:2] for c in cases], "psi double, performance double")
    rows = drift.retraining_decision(df).collect()
    assert [r.should_retrain for r in rows] == [c[2] for c in cases]
    assert len({r.reason.split(":")[0] for r in rows}) == 4
