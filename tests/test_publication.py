"""Several writers: one is taken, the others are refused, nothing is lost."""

import threading

import pytest
from test_rollups import AS_OF, events

from eventide.operators import checkpoint as ck
from eventide.operators import publish as pu
from eventide.operators import serving as sv
from eventide.operators.lease import acquire


@pytest.fixture
def base(tmp_path):
    return "file://" + str(tmp_path / "kept")


def at_once(*jobs):
    """What each of the jobs gives or raises, all begun together."""
    out, gate = [None] * len(jobs), threading.Barrier(len(jobs))

    def run(i, job):
        gate.wait()
        try:
            out[i] = job()
        except Exception as e:  # noqa: BLE001
            out[i] = e

    threads = [threading.Thread(target=run, args=x) for x in enumerate(jobs)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    return out


def test_created_once(spark, base):
    store = pu.Store(spark, base)
    got = at_once(*[lambda i=i: store.create("x/1.json", str(i).encode() * 1000) for i in range(8)])
    assert sorted(got) == [False] * 7 + [True]
    assert store.read("x/1.json") == str(got.index(True)).encode() * 1000 and store.names("x") == ["1.json"]


def test_writers_of_one_base(spark, base):
    assert pu.publish(spark, base, "r0", {"p": spark.range(1)}, {}, None)
    got = at_once(*[lambda i=i: pu.publish(spark, base, f"r{i}", {"p": spark.range(i)}, {}, "r0") for i in (1, 2, 3)])
    assert got.count(True) == 1 and sum(isinstance(x, pu.Stale) for x in got) == 2
    won = got.index(True) + 1
    assert pu.current(spark, base) == f"r{won}" and pu.read_current(spark, base, "p").count() == won
    assert [t["previous"] for t in pu.history(spark, base)] == [None, "r0"]
    # The same run by two writers is one run.
    again = at_once(*[lambda: pu.publish(spark, base, "r9", {"p": spark.range(9)}, {}, f"r{won}") for _ in range(2)])
    assert sorted(again) == [False, True] and pu.read_current(spark, base, "p").count() == 9
    with pytest.raises(pu.Stale, match="was current before"):
        pu.publish(spark, base, "r0", {"p": spark.range(1)}, {}, "r9")
    # What the refused have written is swept, what is or was current stays.
    assert len(pu.sweep(spark, base, -60)) == 3 and pu.read_current(spark, base, "p").count() == 9 and len(pu.Store(spark, base).names("runs")) == 3


def test_no_update_is_lost(spark, base):
    """A delta that was begun before another one finished is refused, and goes through when it is applied again."""
    ck.start(spark, base, "s0", events(spark, [(1, "a", AS_OF - 9, 1), (2, "a", AS_OF - 8, 1)]), AS_OF)
    one, two = events(spark, [(3, "a", AS_OF - 7, 1)]), events(spark, [(4, "a", AS_OF - 6, 1)])
    real, met = ck.advanced, []

    def meanwhile(*args):
        if not met:
            met.append(1)
            ck.advance(spark, base, "s1", "s0", two, AS_OF)
        return real(*args)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(ck, "advanced", meanwhile)
        with pytest.raises(pu.Stale):
            ck.advance(spark, base, "s2", "s0", one, AS_OF)
    assert ck.read(spark, base).canonical.count() == 3 and ck.state(spark, base)["snapshot_id"] == "s1"
    ck.advance(spark, base, "s2", "s1", one, AS_OF)
    assert sorted(r.id for r in ck.read(spark, base).canonical.collect()) == sorted(r.id for r in events(spark, [(i, "a", 0, 1) for i in (1, 2, 3, 4)]).collect())
    assert pu.Store(spark, base).names("work") == []


def test_failed_products_leave_the_run_before(spark, base):
    assert pu.publish(spark, base, "r0", {"p": spark.range(2)}, {}, None)
    with pytest.raises(Exception, match="injected"):
        pu.publish(spark, base, "r1", {"p": spark.range(3), "q": spark.range(3).selectExpr("raise_error('injected') AS x")}, {}, "r0")
    assert pu.current(spark, base) == "r0" and pu.read_current(spark, base, "p").count() == 2


def test_leases_and_fencing(spark, base):
    store, now = pu.Store(spark, base), [100.0]
    clock = lambda: now[0]
    first = acquire(store, "build", "one", 10, clock)
    with pytest.raises(pu.Held, match="held by one"):
        acquire(store, "build", "two", 10, clock)
    now[0] = 105
    first.renew(10)
    now[0] = 112
    assert first.held()
    now[0] = 116
    second = acquire(store, "build", "two", 10, clock)
    assert second.fence == first.fence + 1 and second.held() and not first.held()
    with pytest.raises(pu.Held, match="is lost"):
        first.renew(10)
    # The first writer is slow and comes back: refused before and after the second has published.
    with pytest.raises(pu.Held):
        pu.publish(spark, base, "a", {"p": spark.range(1)}, {}, None, lease=first)
    assert pu.publish(spark, base, "b", {"p": spark.range(2)}, {}, None, lease=second)
    with pytest.raises(pu.Held, match="fencing"):
        pu.publish(spark, base, "c", {"p": spark.range(1)}, {}, "b")
    with second:
        pass
    assert not second.held() and acquire(store, "build", "three", 10, clock).fence == 3
    now[0] = 1000
    got = at_once(*[lambda i=i: acquire(store, "build", str(i), 10, clock) for i in range(5)])
    assert sum(not isinstance(x, Exception) for x in got) == 1 and sum(isinstance(x, pu.Held) for x in got) == 4


def test_object_stores_are_refused(spark, base, monkeypatch):
    class Other:
        def getUri(self):
            return self

        def getScheme(self):
            return "s3a"

    store = pu.Store(spark, base)
    store.fs = Other()
    with pytest.raises(NotImplementedError, match="s3a"):
        store.create("x", b"")


def test_first_queries_of_one_product(spark, tmp_path):
    """Two first queries build side by side and read the same."""
    source = str(tmp_path / "events.parquet")
    spark.range(7).write.parquet(source)
    build = lambda: spark.read.parquet(source).selectExpr("count(*) AS n")
    got = at_once(*[lambda: sv.product(spark, "both", [source], build, 1).first().n for _ in range(3)])
    assert got == [7, 7, 7]


def test_answers_expire_and_are_made_once(spark):
    now, asked = [0.0], []
    answers = sv.Answers(lambda: now[0])

    def query(n=3):
        asked.append(1)
        return spark.range(n)

    got = at_once(*[lambda: answers.get("k", 10, query) for _ in range(4)])
    assert len(asked) == 1 and len({id(x) for x in got}) == 1 and [r.id for r in got[0].rows] == [0, 1, 2]
    assert answers.if_changed("k", 10, query, got[0].etag) is None and len(asked) == 1
    now[0] = 10
    same = answers.get("k", 10, query)
    assert len(asked) == 2 and same.etag == got[0].etag
    answers.forget("k")
    assert answers.if_changed("k", 10, lambda: query(4), same.etag).etag != same.etag
    with pytest.raises(Exception, match="injected"):
        answers.get("bad", 10, lambda: spark.sql("SELECT raise_error('injected')"))
    assert answers.get("bad", 10, query).rows and len(answers.held) == 2
    with pytest.raises(ValueError, match="rows"):
        answers.get("long", 10, lambda: query(20_000))
    now[0] = 99
    answers.get("k", 10, query)
    assert set(answers.held) == {"k"}
