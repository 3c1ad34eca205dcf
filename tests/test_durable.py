"""What goes on where it stopped: comparisons, deliveries, and a lake that is merged while it is read."""

import pytest
from pyspark.sql import functions as F
from test_canonical import rows_of
from test_sources import event, write

from eventide.operators import compact as co
from eventide.operators import publish as pu
from eventide.operators import sharded as sh
from eventide.operators import validate as va
from eventide.session import shared
from eventide.sources import files as fi
from eventide.streaming import delivery as de
from eventide.streaming import ingest


def ids(spark, low, high, skip=()):
    return spark.range(low, high).where(~F.col("id").isin(list(skip) or [-1])).select(F.sha2(F.col("id").cast("string"), 256).alias("id"))


def test_comparison_goes_on(spark):
    """Stopped after each round; finished prefixes aren't read again, and the result is that of a full join."""
    left, right, work = ids(spark, 0, 3000, (7, 500)), ids(spark, 1, 3010, (2000,)), shared(spark, "compare")
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        read.add(1)
        return x

    rounds = 0
    while not sh.compare(left, right, work, few=100, rounds=1, at_once=5):
        rounds += 1
    assert rounds > 4
    assert sh.compare(left.select(seen("id").alias("id")), right, work, few=100, at_once=5) and read.value == 0
    want = {(r.id, "only_left") for r in left.join(right, "id", "left_anti").collect()} | {(r.id, "only_right") for r in right.join(left, "id", "left_anti").collect()}
    got = [tuple(r) for r in sh.differences(spark, work).collect()]
    assert len(got) == len(want) and set(got) == want
    states = {s["state"] for s in sh.finished(spark, work).values()}
    assert states == {"equal", "refined", "differs"} and max(map(len, sh.finished(spark, work))) == 2


def test_comparison_reads_sides_once(spark):
    """A run of many rounds reads each row of the sides once or, where ranges are drawn from a sample, not once a round."""
    left, right, work = ids(spark, 0, 2000, (7,)).cache(), ids(spark, 0, 2000, (8,)), shared(spark, "compare")
    n, read = left.count(), spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        read.add(1)
        return x

    assert sh.compare(left.select(seen("id").alias("id")), right, work, few=300, at_once=2)
    assert len(sh.finished(spark, work)) == 16 and read.value <= 4 * n
    assert {r.side for r in sh.differences(spark, work).collect()} == {"only_left", "only_right"}


def test_comparison_edges(spark):
    work = shared(spark, "compare")
    none = spark.createDataFrame([], "id string")
    assert sh.compare(none, none, work) and sh.differences(spark, work).count() == 0
    work = shared(spark, "compare")
    twice = ids(spark, 0, 5).unionAll(ids(spark, 0, 5)).unionAll(spark.createDataFrame([(None,)], "id string"))
    assert sh.compare(twice, none, work, digits=0, few=2) and sh.differences(spark, work).count() == 5


def test_sink_that_fails(spark, tmp_path):
    """Failing twice: tried again. Failing always: queued, and drained by a later run. Each row once."""
    src, out, waits, fails = tmp_path / "in", str(tmp_path / "out"), [], {0: 2, 1: 99}

    def sink(rows, number):
        if fails.get(number, 0):
            fails[number] -= 1
            raise OSError("down")
        rows.write.mode("overwrite").parquet(f"{out}/batch={number}")

    d = de.Delivery(de.in_parts(sink, 2), "file://" + str(tmp_path / "d"), sleep=waits.append)
    src.mkdir()
    stream = lambda: ingest.events(ingest.lines(spark, str(src), 1))
    for i in range(3):
        write(src / f"{i}.jsonl", *[event(f"{i}-{k}") for k in range(5)])
    d.start(stream(), str(tmp_path / "c")).awaitTermination(120)
    assert waits == [1, 2, 1, 2] and d.queued(spark) == [1] and pu.Store(spark, d.folder).names("failed") == ["000000000001.json"]
    fails.clear()
    assert d.drain(spark) == {1: "delivered"} and d.queued(spark) == [] and d.drain(spark) == {}
    # A lost checkpoint: all batches run again, none is delivered again.
    before = {f for f in (tmp_path / "out").rglob("*.parquet")}
    d.start(stream(), str(tmp_path / "other")).awaitTermination(120)
    kept = spark.read.parquet(out)
    assert {f for f in (tmp_path / "out").rglob("*.parquet")} == before and kept.count() == 15 == kept.select("id").distinct().count()


def test_compaction(spark, tmp_path):
    base = "file://" + str(tmp_path / "lake")
    own = rows_of(spark, 240)
    for i in range(9):
        co.add(spark, base, own.where(f"kind % 12 = {i} OR kind = 0"), files=2)
    now = pu.pointer(spark, base)
    before = co.read(spark, base)
    steps = co.compact(spark, base, 3, 2, files=2)
    levels = co.level_counts(co.state(spark, base))
    assert len(steps) >= 3 and all(n <= 2 for n in levels.values()) and all(len(s["inputs"]) <= 3 for s in steps)
    after = co.read(spark, base)
    want = sorted(r.id for r in own.where("kind % 12 < 9").collect())
    assert sorted(r.id for r in after.collect()) == want
    # Each run is in order, ids once; readers of the state before aren't disturbed.
    for r in co.state(spark, base).values():
        run = fi.lake(spark, f"{base}/{r['folder']}/events")
        assert va.file_order_faults(run).count() == 0 and run.count() == r["rows"] == run.select("id").distinct().count()
    assert sorted(r.id for r in before.collect()) == want == sorted(r.id for r in co.read(spark, base, now).collect())
    assert co.compact(spark, base, 3, 2) == []
    gone = co.clear(spark, base, -60)
    assert gone and sorted(r.id for r in co.read(spark, base).collect()) == want and co.clear(spark, base, -60) == []


def test_addition_during_a_compaction(spark, tmp_path, monkeypatch):
    base, own = "file://" + str(tmp_path / "lake"), rows_of(spark, 60)
    for i in range(3):
        co.add(spark, base, own.where(f"kind % 4 = {i}"), files=1)
    real, met = co._sorted_run, []

    def meanwhile(*args):
        if not met:
            met.append(1)
            co.add(spark, base, own.where("kind % 4 = 3"), files=1)
        return real(*args)

    monkeypatch.setattr(co, "_sorted_run", meanwhile)
    with pytest.raises(pu.Stale):
        co.compact(spark, base, 2, 1, files=1)
    assert co.read(spark, base).count() == 60
    assert co.compact(spark, base, 2, 1, files=1) and co.read(spark, base).count() == 60 and all(n <= 1 for n in co.level_counts(co.state(spark, base)).values())
