"""Reconciliation by ranges against an anti join, and what it moves."""

import pytest
from pyspark.sql import functions as F

from eventide.operators import reconcile as rc
from eventide.session import shared
from eventide.sources import files as fi

SCHEMA = "id string, created_at long"
START = 1_700_000_000


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def missing(spark, ours, theirs, few=4):
    got = rc.reconcile(frame(spark, ours), frame(spark, theirs), shared(spark, "t"), few)
    want = {r for r in theirs if None not in r and r[1] >= 0} - set(ours)
    rows = [tuple(r) for r in got.missing.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    return got


def test_same_ids_as_an_anti_join(spark):
    theirs = [(f"{i:x}", START + i * i % 5000) for i in range(600)]
    ours = [r for i, r in enumerate(theirs) if i % 41] + [("own", START + 3), ("own2", START - 10**6)]
    got = missing(spark, ours, theirs + theirs[:9] + [(None, START), ("late", None)])
    assert got.moved[0] == {"level": 2, "compared": 1, "differ": 1, "ids": 0} and len(got.moved) > 3


def test_equal_empty_and_one_second(spark):
    rows = [(str(i), START) for i in range(300)]  # a crowd within one second: ranges of hashes
    assert missing(spark, rows, rows).moved == [{"level": 8, "compared": 1, "differ": 0, "ids": 0}]
    assert missing(spark, [], []).ids_moved() == 0
    assert missing(spark, [], rows[:3]).ids_moved() == 3
    missing(spark, rows[:100] + rows[101:], rows)
    missing(spark, rows, [])


def test_moved_grows_with_the_difference(spark):
    """Ten ids of 40,000: some hundred ids and a few thousand fingerprints move, not the sides."""
    theirs = spark.range(40_000).select(F.hex("id").alias("id"), (F.lit(START) + F.col("id") * 7 % 1_000_000).alias("created_at"))
    ours = theirs.where("conv(id, 16, 10) % 4001 <> 0")
    got = rc.reconcile(ours, theirs, shared(spark, "t"))
    lost = theirs.join(ours, "id", "left_anti")
    assert sorted(map(tuple, got.missing.collect())) == sorted(map(tuple, lost.collect())) and 5 < lost.count() < 20
    assert got.ids_moved() <= 2 * rc.FEW * rc.FAN * lost.count() / 4 and sum(m["compared"] for m in got.moved) <= 1 + 25 * rc.FAN * lost.count()


def test_footers(spark, tmp_path):
    at = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "cast(id AS string) AS s", "IF(id % 2 = 0, id, NULL) AS n").repartition(3).write.parquet(at)
    out = fi.footer_facts(spark, at, bounds=("id", "n"))
    assert tuple(out.first()) == (1000, 0, 999, 0, 998)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MIN(id)" in plan and spark.conf.get("spark.sql.sources.useV1SourceList") != ""
    with pytest.raises(ValueError, match="footers"):
        fi.footer_facts(spark, at, bounds=("s",))
