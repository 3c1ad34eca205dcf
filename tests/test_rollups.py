"""The rollup and first-seen fixtures, with their exact numbers."""

import pytest
from pyspark.sql import functions as F

from eventide.functions import time as tm
from eventide.operators import checkpoint as ck
from eventide.operators import lifecycle as li
from eventide.operators import rollups as ro
from eventide.operators import serving as sv
from eventide.operators import users as us
from eventide.schema import DAY, GENESIS, WEEK

AS_OF = 1_700_000_000


def events(spark, rows):
    return spark.createDataFrame(rows, "id string, pubkey string, created_at long, kind int")


@pytest.fixture(scope="module")
def two_objects(spark):
    first = [("dup", "a", AS_OF - 10, 1), ("low", "a", AS_OF - WEEK, 2), ("pre", "b", 100, 3), ("over", "a", 4_294_967_296, 4)]
    second = [("dup", "a", AS_OF - 10, 1), ("rec", "a", AS_OF - 100_000, 2), ("fut", "a", AS_OF + 100, 5)]
    return events(spark, first), events(spark, second)


def test_overview_and_accounting(spark, two_objects):
    first, second = two_objects
    made = li.build(first.unionByName(second))
    a = li.check(made)
    assert (a["physical"], a["logical"], a["duplicate"], a["representable"]) == (7, 6, 1, 5)
    o = ro.overview(made.canonical, AS_OF).first()
    assert (o.earliest_event, o.latest_event, o.events_7d, o.kinds_30d) == (GENESIS, AS_OF - 10, 4, 3)
    capped = ro.overview(made.canonical.where(F.col("created_at") <= AS_OF), AS_OF).first()
    assert (capped.events_7d, capped.events_per_hour_7d, capped.kinds_30d) == (3, 3 / 168, 2)
    assert a["daily_sum"] == a["daily_kind_sum"] == 5
    assert sorted((r.kind, r.event_count) for r in made.kinds.collect()) == [(1, 1), (2, 2), (3, 1), (4, 1), (5, 1)]


def test_incremental_equals_batch_and_is_idempotent(spark, two_objects):
    first, second = two_objects
    whole, step = li.build(first.unionByName(second)), li.apply_delta(li.build(first), second)
    again = li.apply_delta(step, second)
    for made in (step, again):
        for name in ("daily", "daily_kind", "kinds"):
            assert sorted(map(tuple, getattr(made, name).collect())) == sorted(map(tuple, getattr(whole, name).collect()))
    li.check(step)


def test_conflicts_stop(spark, two_objects):
    first, _ = two_objects
    with pytest.raises(ValueError, match="conflicting"):
        li.apply_delta(li.build(first), events(spark, [("dup", "a", AS_OF - 10, 9)]))
    with pytest.raises(ValueError, match="conflicting"):
        li.build(events(spark, [("x", "a", 1, 1), ("x", "a", 2, 1)]))


def test_empty_snapshot(spark):
    made = li.build(events(spark, []))
    assert li.check(made)["logical"] == 0 and made.daily.isEmpty() and ro.overview(made.canonical, AS_OF).first().earliest_event == GENESIS


def test_first_seen(spark):
    rows = [("1", "first", AS_OF - DAY, 1), ("2", "first", AS_OF - 10, 1), ("3", "second", AS_OF - 86_500, 445), ("4", "second", AS_OF - 10, 1), ("5", "old", 100, 1), ("6", "old", AS_OF - 10, 1), ("7", "future", AS_OF + 10, 1)]
    seen = us.first_seen(events(spark, rows))
    assert seen.count() == 4 and us.eligible(seen, AS_OF).count() == 2
    new = us.new_users(seen, AS_OF).collect()
    assert len(new) == 2 and sum(r.new_users for r in new) == 2


def test_late_event_moves_a_user_to_an_earlier_day(spark):
    base = us.first_seen(events(spark, [("1", "a", AS_OF - 10, 1)]))
    delta = us.first_seen(events(spark, [("2", "a", AS_OF - 172_800, 1), ("3", "b", AS_OF - 20, 1)]))
    new = us.new_users(us.advance(base, delta), AS_OF).collect()
    assert sorted(r.new_users for r in new) == [1, 1] and len({r.period for r in new}) == 2


def test_retention_size_is_the_own_period(spark):
    table = spark.createDataFrame([("2024-01-01", "2024-01-01", 4), ("2024-01-01", "2024-01-08", 1), ("2024-01-08", "2024-01-15", 3)], "cohort string, activity_period string, active_count long")
    a, b = us.retention(table, limit=5).collect()
    assert (a.cohort_size, list(a.retention), list(a.retention_pct)) == (4, [4, 1], [100.0, 25.0])
    assert (b.cohort_size, list(b.retention_pct)) == (0, [0.0])
    assert us.retention(table, limit=5, oldest_present_is_size=True).collect()[1].cohort_size == 3


def test_time_functions(spark):
    t = tm.seconds_of("2024-01-31T23:59:59")
    row = spark.range(1).select(tm.shown(tm.day(F.lit(t))).alias("d"), tm.shown(tm.week(F.lit(t))).alias("w"), tm.shown(tm.month(F.lit(t))).alias("m"), tm.hour_of_day(F.lit(t)).alias("h"), tm.iso(F.lit(t)).alias("i"), tm.hours_between(F.lit(t), F.lit(t + 1)).alias("n")).first()
    assert tuple(row) == ("2024-01-31", "2024-01-29", "2024-01-01", 23, "2024-01-31T23:59:59Z", 1)
    assert tm.previous_hour(7300) == (3600, 7200) and tm.window_start(5, 10) == 0
    with pytest.raises(ValueError):
        tm.bucket("x", "year")


def test_limits():
    assert ro.limits(None, 30, 365) == 30 and ro.limits(999, 30, 365) == 365
    with pytest.raises(ValueError):
        ro.limits(0, 1, 2)
    with pytest.raises(ValueError):
        ro.choice("x", {"a": 1})


def test_windows_are_half_open(spark):
    e = events(spark, [("1", "a", 10, 1), ("2", "a", 20, 1), ("3", "a", 30, 2)])
    assert ro.within(e, since=10, until=30).count() == 2 and ro.within(e, as_of=20).count() == 2 and ro.within(e, kind=2).count() == 1
    with pytest.raises(ValueError):
        ro.within(e, days=3)


def test_gate_and_classes():
    assert (li.gate(True, 0), li.gate(True, 2), li.gate(False, 0)) == ("passed", "failed", "incomplete")
    assert (li.classify(True, False), li.classify(False, True), li.classify(False, False)) == ("exact", "bug", "uncertainty")


def test_filters_reach_the_scan(spark, tmp_path):
    from eventide.sources.files import lake
    from eventide.schema import EVENT, warehouse

    spark.createDataFrame([], EVENT).write.parquet(str(tmp_path / "l"))
    plan = warehouse(lake(spark, str(tmp_path / "l"))).select("kind").where("kind = 1")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(created_at" in plan and "EqualTo(kind,1)" in plan and "content" not in plan.split("ReadSchema")[1]


def test_kept_builds_advance_by_deltas(spark, two_objects, tmp_path):
    """Only new ids are inserted, a repeat changes nothing, a dry run leaves all as it is."""
    base, first, second = "file://" + str(tmp_path / "kept"), *two_objects
    ck.start(spark, base, "s1", first, AS_OF)
    dry = ck.advance(spark, base, "s2", "s1", second, AS_OF, dry_run=True)
    assert ck.state(spark, base)["snapshot_id"] == "s1" and ck.read(spark, base).canonical.count() == 4
    done = ck.advance(spark, base, "s2", "s1", second, AS_OF)
    assert dry == done == ck.Summary(3, 3, 0, 1, 2) and len(ck.state(spark, base)["parts"]) == 2
    whole, kept = li.build(first.unionByName(second)), ck.read(spark, base)
    for name in ("daily", "daily_kind", "kinds"):
        assert sorted(map(tuple, getattr(kept, name).collect())) == sorted(map(tuple, getattr(whole, name).collect()))
    assert ck.overview(spark, base).collect() == ro.overview(whole.canonical, AS_OF).collect()
    again = ck.advance(spark, base, "s2", "s1", second, AS_OF)
    assert again.already_applied and again.inserted_events == 0 and ck.read(spark, base).canonical.count() == 6
    with pytest.raises(ValueError, match="as_of"):
        ck.advance(spark, base, "s2", "s1", second, AS_OF + 1)
    with pytest.raises(ValueError, match="begins at"):
        ck.advance(spark, base, "s4", "s3", second, AS_OF)
    with pytest.raises(ValueError, match="conflicting"):
        ck.advance(spark, base, "s3", "s2", events(spark, [("dup", "a", AS_OF - 10, 9)]), AS_OF)
    with pytest.raises(FileExistsError):
        ck.start(spark, base, "s1", first, AS_OF)
    with pytest.raises(FileNotFoundError):
        ck.advance(spark, base + "-none", "s2", "s1", second, AS_OF)


def test_serving_tables_follow_their_sources(spark, tmp_path):
    source, built = str(tmp_path / "events.parquet"), []
    spark.range(3).write.parquet(source)

    def build():
        built.append(1)
        return spark.read.parquet(source).agg(F.count("*").alias("n"))

    read = lambda: sv.product(spark, "n", [source], build, 1).first().n
    assert (read(), read(), len(built)) == (3, 3, 1)
    spark.range(2).write.mode("append").parquet(source)
    assert (read(), read(), len(built)) == (5, 5, 2)
