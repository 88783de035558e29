"""Behaviour columns on a stream: state under a watermark gives the batch operators' columns."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest

from tidewatch.operators import behaviour as batch
from tidewatch.plans import stream_queries
from tidewatch.plans.catalogue import QUERIES
from tidewatch.sources.tables import read_table
from tidewatch.streaming import behaviour

START = datetime(2024, 1, 1)
SCHEMA = "id long, host int, service string, ts timestamp, bad boolean"
ROLES = behaviour.Behaviour("host", "service", "ts", "id", "bad", seconds=30, last=5)


def fed(spark, tmp_path, parts, lateness):
    folder, output = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in parts:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    behaviour.behaviour_stream(stream, ROLES, output, lateness).awaitTermination()
    return output


def by_id(df):
    return {r.id: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    # Host 0 has most rows; bursts share an instant.
    return [(i, 0 if i % 3 else i % 5, "abc"[i * i % 7 % 3], START + timedelta(seconds=4 * (i // 2)), i % 4 == 0) for i in range(200)]


def test_late_within_the_watermark(spark, tmp_path, rows):
    delayed = sorted(rows, key=lambda r: r[3] + timedelta(seconds=(r[0] * 37) % 40))
    output = fed(spark, tmp_path, [delayed[k : k + 50] for k in range(0, 200, 50)], 40)
    want = by_id(ROLES.features(spark.createDataFrame(rows, SCHEMA)))
    assert by_id(behaviour.behaviour_so_far(spark, output, ROLES)) == want
    out = by_id(behaviour.released(spark, output))
    assert 100 < len(out) < 200 and all(want[i] == r for i, r in out.items())
    assert spark.read.parquet(f"{output}/late").count() == 0
    # The state stays small: what waits, what the last seconds hold and `last` - 1 rows for each host.
    state = spark.read.parquet(f"{output}/rows/micro=3")
    assert state.where("_released").count() <= 5 * 4 + 2 * 30 // 4 + 4


def test_too_late_and_unknown(spark, tmp_path, rows):
    late = [(1000, 0, "a", START, False)]
    unknown = [(2000, None, "a", START, False), (None, 1, "a", START, False), (2001, 1, "a", None, False)]
    output = fed(spark, tmp_path, [rows[:100], rows[100:] + late + unknown, late], 10)
    assert [r.id for r in spark.read.parquet(f"{output}/late").collect()] == [1000, 1000]
    got = behaviour.behaviour_so_far(spark, output, ROLES)
    assert got.count() == 203 and got.where("dst_host_count IS NULL AND count IS NULL").count() == 3
    want = by_id(ROLES.features(spark.createDataFrame(rows, SCHEMA)))
    assert {i: r for i, r in by_id(got).items() if i in want} == want


def test_a_repeated_micro_batch_changes_nothing(spark, tmp_path, rows):
    output = fed(spark, tmp_path, [rows[:120], rows[120:]], 20)
    before, state = by_id(behaviour.released(spark, output)), spark.read.parquet(f"{output}/rows/micro=1").count()
    # The last micro-batch's commit is lost: the stream does it again.
    (tmp_path / "out" / "_progress" / "commits" / "1").unlink()
    (tmp_path / "out" / "_progress" / "commits" / ".1.crc").unlink(missing_ok=True)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    behaviour.behaviour_stream(stream, ROLES, output, 20).awaitTermination()
    assert by_id(behaviour.released(spark, output)) == before
    assert spark.read.parquet(f"{output}/rows/micro=1").count() == state


def test_large_keys_of_a_stream(spark, tmp_path, rows, monkeypatch):
    """Hosts and services too large for a task, and too many hosts to be named: the same columns from state and new rows together."""
    monkeypatch.setattr(batch, "TASK_ROWS", 30)
    monkeypatch.setattr(batch, "NAMED_HOSTS", 0)
    monkeypatch.setattr(behaviour, "NAMED_HOSTS", 0)
    delayed = sorted(rows, key=lambda r: r[3] + timedelta(seconds=(r[0] * 37) % 40))
    output = fed(spark, tmp_path, [delayed[:100], delayed[100:]], 40)
    assert spark.read.parquet(f"{output}/rows/micro=1").where("_released").count() <= 5 * 4 + 2 * 30 // 4 + 4
    monkeypatch.undo()
    want = by_id(ROLES.features(spark.createDataFrame(rows, SCHEMA)))
    assert by_id(behaviour.behaviour_so_far(spark, output, ROLES)) == want


def test_arrivals_are_several_files(spark, folder, monkeypatch):
    """A micro-batch's files are as many as tasks can share, each micro-batch has its own, and no event is late."""
    monkeypatch.setattr(stream_queries, "FILE_ROWS", 60)
    made, start = [], behaviour.behaviour_stream
    monkeypatch.setattr(behaviour, "behaviour_stream", lambda stream, roles, output, late: made.append(output) or start(stream, roles, output, late))
    result = QUERIES["stream_behaviour"](spark, folder)
    output, = made
    assert spark.read.parquet(f"{output}/late").count() == 0
    progress = Path(output) / "_progress" / "sources" / "0"
    assert [len((progress / str(k)).read_text().splitlines()) - 1 for k in range(stream_queries.PARTS)] == [4] * stream_queries.PARTS
    assert result.count() == read_table(spark, folder, "events").count()
