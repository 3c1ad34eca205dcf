"""State over streams: equal to the batch fold after restarts, and gone when it is over."""

import random

from pyspark.sql import functions as F
from test_sources import event, write

from eventide.operators.relays import connection_states
from eventide.streaming import ingest, state

SCHEMA = "relay_url string, at long, success boolean"
LAST = 2_000_000


def test_streaming_equals_batch_after_restarts(spark, tmp_path):
    rng = random.Random(4)
    rows = [(f"r{i % 7}", 1000 + 10 * i + i % 7, rng.random() < (0.05 if i % 7 < 3 else 0.5)) for i in range(210)]
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    batches, size = [], 70
    for a in range(0, len(rows), size):
        batch = rows[a : a + size]
        rng.shuffle(batch)  # out of order within the delay
        batches.append(batch)
    batches.append([("late", LAST, True)])  # moves the watermark behind all others

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(str(src))
        state.start_connections(stream, out, str(tmp_path / "check"), "1000 seconds", block_after=4, idle=10_000_000).awaitTermination(240)

    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").json(str(src / f"b{i}"))
        for f in (src / f"b{i}").glob("part-*.json"):
            f.rename(src / f"{i}.json")
        if i in (1, len(batches) - 1):  # a start, and a start again from the checkpoint
            run()
    got = {r.relay_url: (r.status, r.consecutive_failures, r.last_connected_at, r.blocked_reason) for r in state.newest(spark.read.parquet(out)).collect()}
    want = {r.relay_url: (r.status, r.consecutive_failures, r.last_connected_at, r.blocked_reason) for r in connection_states(spark.createDataFrame(rows, SCHEMA), 4).collect()}
    assert {k: v for k, v in got.items() if k != "late"} == want and "blocked" in {v[0] for v in want.values()}


def test_state_expires(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for i, rows in enumerate(([("a", 1000, False), ("b", 1000, True)], [("b", 90_000, True)], [("c", LAST, True)])):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.json(str(tmp_path / f"b{i}"))
        next((tmp_path / f"b{i}").glob("part-*.json")).rename(src / f"{i}.json")
        state.start_connections(spark.readStream.schema(SCHEMA).json(str(src)), out, str(tmp_path / "check"), "10 seconds", idle=50_000).awaitTermination(240)
    got = {r.relay_url: r.status for r in state.newest(spark.read.parquet(out)).collect()}
    assert got["a"] == "expired" and got["b"] == "expired" and spark.read.parquet(out).where("relay_url = 'b' AND status = 'active'").agg(F.max("at")).first()[0] == 90_000


def test_hours_with_a_watermark(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    write(src / "1.jsonl", event("a", at=10), event("b", at=20), event("c", at=100_000))
    stream = lambda: state.hourly_within(ingest.events(ingest.lines(spark, str(src), 1)), "1 hour")
    run = lambda: stream().writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(240)
    run()
    write(src / "2.jsonl", event("d", at=30), event("e", at=200_000))  # d is behind the watermark
    run()
    got = sorted((r.hour_start, r.events) for r in spark.read.parquet(str(tmp_path / "o")).collect())
    assert got == [(0, 2), (97_200, 1)]
