"""Windows by running sums against brute force, with a host holding half the rows and bursts of equal times."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewatch.functions.prefix import in_cells, running_number
from tidewatch.functions.storage import shared_folder
from tidewatch.operators import behaviour
from tidewatch.operators.behaviour import hundred_connection_features, two_second_features
from tidewatch.plans.catalogue import QUERIES
from tidewatch.sources import views


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(4)
    start = datetime(2024, 1, 1, 0, 0, 0)
    found = []
    for i in range(600):
        host = 0 if draw.random() < 0.5 else draw.randint(1, 4)
        ts = start + timedelta(milliseconds=500 * draw.randint(0, 400))
        found.append((i, host, draw.choice("abc"), ts, draw.random() < 0.3, draw.randint(1, 3), draw.randint(1, 3)))
    return found


@pytest.fixture(scope="module")
def df(spark, rows):
    schema = "id int, host int, service string, ts timestamp, bad boolean, port int, source int"
    unknown = [(1000, None, "a", rows[0][3], True, 1, 1), (1001, 1, "a", None, True, 1, 1)]
    return spark.createDataFrame(rows + unknown, schema).repartition(6)


def near(a, b):
    return a == pytest.approx(b, abs=1e-12)


@pytest.mark.parametrize("cells", [None, 1, 40])
def test_last_seconds(df, rows, cells):
    result = two_second_features(df, "host", "service", "ts", F.col("bad"), ~F.col("bad"), seconds=2, cells=cells)
    found = {r.id: r for r in result.collect()}
    assert len(found) == 602 and found[1000]["count"] is None and found[1001]["count"] is None
    for i, host, service, ts, *_ in rows:
        recent = [r for r in rows if timedelta(0) <= ts - r[3] <= timedelta(seconds=2)]
        same_host = [r for r in recent if r[1] == host]
        same_service = [r for r in recent if r[2] == service]
        both = [r for r in same_host if r[2] == service]
        row = found[i]
        assert (row["count"], row.srv_count) == (len(same_host), len(same_service))
        assert near(row.serror_rate, sum(r[4] for r in same_host) / len(same_host))
        assert near(row.srv_rerror_rate, sum(not r[4] for r in same_service) / len(same_service))
        assert near(row.same_srv_rate, len(both) / len(same_host)) and near(row.diff_srv_rate, 1 - len(both) / len(same_host))
        assert near(row.srv_diff_host_rate, 1 - len(both) / len(same_service))


@pytest.mark.parametrize("cells", [None, 1, 40])
def test_last_connections(df, rows, cells):
    result = hundred_connection_features(
        df, "host", "service", "ts", "id", F.col("bad"), source_port="port", source="source",
        last=10, cells=cells,
    )
    found = {r.id: r for r in result.collect()}
    assert len(found) == 602 and found[1000].dst_host_count is None
    ordered = sorted(rows, key=lambda r: (r[3], r[0]))
    for host in range(5):
        mine = [r for r in ordered if r[1] == host]
        for k, (i, _, service, _, _, port, source) in enumerate(mine):
            last = mine[max(0, k - 9): k + 1]
            same = [r for r in last if r[2] == service]
            row = found[i]
            assert (row.dst_host_count, row.dst_host_srv_count) == (len(last), len(same))
            assert near(row.dst_host_serror_rate, sum(r[4] for r in last) / len(last))
            assert near(row.dst_host_srv_serror_rate, sum(r[4] for r in same) / len(same))
            assert near(row.dst_host_same_src_port_rate, sum(r[5] == port for r in last) / len(last))
            assert near(row.dst_host_srv_diff_host_rate, 1 - sum(r[6] == source for r in same) / len(same))


@pytest.mark.parametrize("name", ["window_2s_counts", "window_100_rates"])
def test_plans_stay_flat(spark, folder, name):
    """The input is scanned for the base and for the join, known and unknown rows apart; nothing doubles."""
    events = views.events(spark, folder)
    before = len(stored_tables(spark))
    result = QUERIES[name](spark, folder)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") <= 3 and plan.count("Relation") <= 4, plan
    assert len(stored_tables(spark)) - before <= 2
    assert result.count() == events.count()


def stored_tables(spark):
    return list(Path(shared_folder(spark)).glob("table-*"))


def test_cells_split_a_hot_key(spark):
    """A host with two thirds of all rows: no cell holds more than its share, and numbers are those of one order."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("host"), (F.col("id") * 7919 % 30_011).alias("ts"), "id")
    cut = in_cells(df, ["host", "ts", "id"], 16)
    sizes = [r["count"] for r in cut.groupBy("_cell").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 30_000 / 16
    numbered = running_number(df, ["host", "ts", "id"], "k", 16).orderBy("host", "ts", "id").collect()
    assert [r.k for r in numbered] == list(range(1, 30_001))


def test_connections_without_port_or_source_stay(spark, rows):
    some = [(i, host, service, ts, bad, None if i % 5 == 0 else port, None if i % 7 == 0 else source) for i, host, service, ts, bad, port, source in rows]
    df = spark.createDataFrame(some, "id int, host int, service string, ts timestamp, bad boolean, port int, source int").repartition(4)
    found = {r.id: r for r in hundred_connection_features(df, "host", "service", "ts", "id", source_port="port", source="source", last=10).collect()}
    assert len(found) == len(some)
    ordered = sorted(some, key=lambda r: (r[3], r[0]))
    for host in range(5):
        mine = [r for r in ordered if r[1] == host]
        for k, (i, _, service, _, _, port, source) in enumerate(mine):
            last = mine[max(0, k - 9): k + 1]
            same = [r for r in last if r[2] == service]
            assert near(found[i].dst_host_same_src_port_rate, sum(r[5] == port for r in last) / len(last))
            assert near(found[i].dst_host_srv_diff_host_rate, 1 - sum(r[6] == source for r in same) / len(same))


def roles():
    return "host", "service", "ts", "id", F.col("bad"), ~F.col("bad"), "port", "source"


def by_id(df):
    return {r.id: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("task_rows", [1_000_000, 150, 1])
def test_both_sets_whatever_a_task_orders(spark, df, rows, monkeypatch, task_rows):
    """All keys by tasks, the large ones by marks, all by marks: the columns of the two operators, gaps in any role included."""
    monkeypatch.setattr(behaviour, "TASK_ROWS", task_rows)
    ts = rows[0][3]
    schema = "id int, host int, service string, ts timestamp, bad boolean, port int, source int"
    odd = [(None, 0, "a", ts, True, 1, 1), (1002, 0, "a", ts, None, None, 2), (1003, 4, "b", ts, False, None, None), (1004, 4, None, ts, False, 1, 1)]
    everything = df.unionByName(spark.createDataFrame(odd, schema))
    recent = two_second_features(everything, *roles()[:3], *roles()[4:6], seconds=20)
    want = hundred_connection_features(recent, *roles(), last=10)
    got = behaviour.connection_features(everything, *roles(), seconds=20, last=10)
    assert got.columns == want.columns and got.count() == 606
    assert by_id(got) == by_id(want)
    # From an instant on: the rows of that time with all their columns, and nothing else.
    middle = sorted(r[3] for r in rows)[400]
    later = behaviour.connection_features(everything, *roles(), seconds=20, last=10, since=int(middle.timestamp() * 1_000_000))
    assert by_id(later) == {i: r for i, r in by_id(want).items() if r["ts"] is not None and r["ts"] >= middle and r["host"] is not None and r["service"] is not None}


def test_keys_of_a_task_need_no_marks(spark, df):
    """Hosts and services that a task can order are neither dealt to cells nor stored as marks."""
    before = len(stored_tables(spark))
    result = behaviour.connection_features(df, *roles())
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert len(stored_tables(spark)) == before and "inline" not in plan and plan.count("Join") == 1, plan
