"""State over streams that ends: relays' connection states folded in order of time, hourly counts with a watermark.

``connections`` keeps for each relay what :func:`relays.connection_states`
computes over a table. Attempts wait in the relay's state until the watermark
has passed them (a timer each), so they are folded in order however they come
within the delay; attempts behind the watermark are left out. A relay without an
attempt for ``idle`` seconds, and none waiting, is given out as expired and its
state goes.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

OUT = "relay_url string, at long, status string, consecutive_failures long, last_connected_at long, blocked_reason string"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Connections(StatefulProcessor):
    def __init__(self, block_after: int, idle: int):
        self.block_after, self.idle = block_after, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.folded = handle.getValueState("folded", "failures long, connected long, at long")
        self.waiting = handle.getListState("waiting", "at long, success boolean")

    def handleInputRows(self, key, rows, timerValues):
        passed, times = timerValues.getCurrentWatermarkInMs(), set()
        for row in rows:
            if row.at * 1000 > passed:
                self.waiting.appendValue((row.at, bool(row.success)))
                times.add(row.at)
        for at in times:
            self.handle.registerTimer(at * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = expiredTimerInfo.getExpiryTimeInMs() // 1000
        held = [(r[0], r[1]) for r in self.waiting.get()]
        # Of two at the same second a success is the later.
        due, rest = sorted(x for x in held if x[0] <= now), [x for x in held if x[0] > now]
        failures, connected, last = self.folded.get() if self.folded.exists() else (0, None, None)
        if not due:
            if last is not None and not rest and last + self.idle <= now:
                self.folded.clear()
                yield self._row(key, now, failures, connected, "expired")
            return
        for at, success in due:
            failures, connected, last = (0, at, at) if success else (failures + 1, connected, at)
        self.folded.update((failures, connected, last))
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        yield self._row(key, last, failures, connected)
        if not rest and (last + self.idle) * 1000 <= timerValues.getCurrentWatermarkInMs():
            self.folded.clear()
            yield self._row(key, last + self.idle, failures, connected, "expired")
        else:
            self.handle.registerTimer((last + self.idle) * 1000)

    def _row(self, key, at: int, failures: int, connected: int | None, status: str | None = None) -> Row:
        blocked = failures >= self.block_after
        status = status or ("blocked" if blocked else "failing" if failures else "active")
        return Row(relay_url=key[0], at=at, status=status, consecutive_failures=failures, last_connected_at=connected, blocked_reason=f"Blocked after {failures} consecutive failures" if blocked else None)

    def close(self) -> None:
        pass


def connections(attempts: DataFrame, delay: str, block_after: int = 10, idle: int = 7 * 86_400) -> DataFrame:
    """A row each time that a relay's state has moved on; attempts: relay_url, at (seconds), success."""
    timed = attempts.where("relay_url IS NOT NULL AND at IS NOT NULL").select("relay_url", F.col("at").cast("bigint").alias("at"), F.coalesce("success", F.lit(False)).alias("success"), F.timestamp_seconds("at").alias("ts")).withWatermark("ts", delay)
    return timed.groupBy("relay_url").transformWithState(Connections(block_after, idle), outputStructType=OUT, outputMode="Update", timeMode="EventTime")


def newest(rows: DataFrame) -> DataFrame:
    """The last state of each relay of what ``connections`` has given out."""
    nth = F.row_number().over(Window.partitionBy("relay_url").orderBy(F.desc("at"), F.desc(F.col("status") == "expired")))
    return rows.withColumn("nth", nth).where("nth = 1").drop("nth")


def hourly_within(stream: DataFrame, delay: str, key: str = "pubkey") -> DataFrame:
    """Counts by hour and key, whose state goes once the watermark has passed the hour; later events don't count."""
    timed = stream.withColumn("_ts", F.timestamp_seconds("created_at")).withWatermark("_ts", delay)
    return timed.groupBy(F.window("_ts", "1 hour").alias("w"), key).agg(F.count("*").alias("events")).select(F.unix_timestamp("w.start").alias("hour_start"), key, "events")


@contextmanager
def state_store(spark: SparkSession):
    """Queries that are started here keep their state in RocksDB, which state of one's own needs."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def start_connections(attempts: DataFrame, out: str, checkpoint: str, delay: str, **options) -> StreamingQuery:
    """What is given out, each batch's rows in a folder of its number, so that a batch that runs again replaces its own."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    with state_store(attempts.sparkSession):
        return connections(attempts, delay, **options).writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
