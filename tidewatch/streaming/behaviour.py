"""Behaviour columns at scoring time: the batch operators over what a stream still has to know.

State, kept for each micro-batch in a folder of its own (a repeated micro-batch reads the state
before it and writes the same again):

    rows    connections that wait for the watermark, and those already released that later frames
            reach back to: all within the last seconds, and the last connections of each host
    clock   the watermark: the largest event time seen less the allowed lateness

A micro-batch releases, with all columns, what the new watermark has passed. Nothing can come
before a released row any more, so its columns are those of the whole table. A connection that comes after the
watermark has passed it goes to `late`, as it is; connections without host, service, time or id are released at once with NULL
columns. The state holds `last` - 1 rows for each host, the rows of the last seconds and those within the lateness.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewatch.functions.joins import fits_broadcast
from tidewatch.functions.storage import materialize
from tidewatch.operators.behaviour import MICROS, NAMED_HOSTS, connection_features

CLOCK = "micro long, watermark long"


@dataclass(frozen=True)
class Behaviour:
    """Roles of a connection's columns, and how far its frames reach; the two conditions are SQL expressions."""

    host: str
    service: str
    ts: str
    row_id: str
    syn_error: str | None = None
    rejected: str | None = None
    source_port: str | None = None
    source: str | None = None
    seconds: int = 2
    last: int = 100

    def features(self, rows: DataFrame, since: int | None = None) -> DataFrame:
        conditions = [F.expr(c) if c else None for c in (self.syn_error, self.rejected)]
        return connection_features(rows, self.host, self.service, self.ts, self.row_id, *conditions, self.source_port, self.source,
                                   self.seconds, self.last, since=since)

    def known(self) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (self.host, self.service, self.ts, self.row_id)])

    def time(self) -> Column:
        return F.unix_micros(F.col(self.ts).cast("timestamp"))


def _state(spark: SparkSession, output: str, before: int | None = None) -> tuple[int, int | None]:
    """Number and watermark of the newest micro-batch (before the given one)."""
    clock = spark.read.schema(CLOCK).option("recursiveFileLookup", True).parquet(f"{output}/clock")
    newest = (clock if before is None else clock.where(F.col("micro") < before)).orderBy(F.desc("micro")).first()
    return newest["micro"], newest["watermark"]


def _kept(released: DataFrame, waiting: DataFrame, roles: Behaviour, watermark: int) -> DataFrame:
    """The next state: what waits, and the released rows that later frames reach."""
    near = roles.time() > watermark - roles.seconds * MICROS
    # A host with fewer connections than `last` keeps them all; the others are ranked, all hosts if those are too many to be named.
    crowded = materialize(released.groupBy(roles.host).count().where(F.col("count") >= roles.last).select(roles.host))
    named = fits_broadcast(crowded, NAMED_HOSTS)
    ranked = released.join(F.broadcast(crowded), roles.host, "left_semi") if named else released
    newest = Window.partitionBy(roles.host).orderBy(F.desc(roles.ts), F.desc(roles.row_id))
    # Rank and limit stand together, so tasks send at most `last` rows of a host to it.
    recent = ranked.withColumn("_age", F.row_number().over(newest)).where((F.col("_age") < roles.last) & ~near).drop("_age")
    needed = recent.unionByName(released.where(near))
    needed = needed.unionByName(released.join(F.broadcast(crowded), roles.host, "left_anti").where(~near)) if named else needed
    return needed.withColumn("_released", F.lit(True)).unionByName(waiting.withColumn("_released", F.lit(False)))


def behaviour_stream(stream: DataFrame, roles: Behaviour, output: str, lateness_seconds: int) -> StreamingQuery:
    """Release connections with their columns to `output`/released; `behaviour_so_far` reads them with the waiting ones."""
    spark = stream.sparkSession
    empty = spark.createDataFrame([], stream.schema).withColumn("_released", F.lit(False))
    empty.write.mode("ignore").parquet(f"{output}/rows/micro=-1")
    spark.createDataFrame([(-1, None)], CLOCK).write.mode("ignore").parquet(f"{output}/clock/first")

    def write(rows: DataFrame, part: str, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{output}/{part}/micro={batch_id}")

    def work(frame: DataFrame, batch_id: int) -> None:
        session, known, time = frame.sparkSession, roles.known(), roles.time()
        before, passed = _state(session, output, batch_id)
        came = frame.persist()
        try:
            newest = came.where(known).agg(F.max(time)).first()[0]
            watermark = max((x for x in (passed, None if newest is None else newest - lateness_seconds * MICROS) if x is not None), default=None)
            late = known & (time <= passed) if passed is not None else F.lit(False)
            write(came.where(late), "late", batch_id)
            state = session.read.schema(empty.schema).parquet(f"{output}/rows/micro={before}")
            pool = state.unionByName(came.where(known & ~late).withColumn("_released", F.lit(False)))
            due = time <= watermark if watermark is not None else F.lit(False)
            # What an earlier watermark has passed is released already, and all else is later.
            featured = roles.features(pool.where(due).drop("_released"), None if passed is None else passed + 1)
            write(featured.unionByName(came.where(~known), allowMissingColumns=True), "released", batch_id)
            passing, waiting = pool.where(due).drop("_released"), pool.where(~due).drop("_released")
            write(_kept(passing, waiting, roles, watermark if watermark is not None else 0), "rows", batch_id)
            session.createDataFrame([(batch_id, watermark)], CLOCK).write.mode("overwrite").parquet(f"{output}/clock/{batch_id}")
        finally:
            came.unpersist()

    return stream.writeStream.foreachBatch(work).option("checkpointLocation", f"{output}/_progress").trigger(availableNow=True).start()


def released(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.option("basePath", f"{output}/released").parquet(f"{output}/released").drop("micro")


def behaviour_so_far(spark: SparkSession, output: str, roles: Behaviour) -> DataFrame:
    """Released connections, and the waiting ones with the columns they have if nothing more comes before them."""
    newest, watermark = _state(spark, output)
    state = spark.read.parquet(f"{output}/rows/micro={newest}").drop("_released")
    waiting = roles.features(state, None if watermark is None else watermark + 1)
    return released(spark, output).unionByName(waiting)
