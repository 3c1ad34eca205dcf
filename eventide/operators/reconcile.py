"""Set reconciliation by ranges: two sides find the ids that one of them lacks by comparing fingerprints, and move ids only where these differ.

A side's ids are ordered by (created_at, id) and cut into a tree of ranges:
each range has its number of ids and a 128-bit fingerprint, the exclusive or of
its ids' hashes, and is cut into ``FAN`` ranges below it. The sides compare the
topmost ranges first and go down only where they differ; ranges that differ at
the bottom, or hold ``FEW`` ids at most on both sides, are settled by moving
their ids. A tree is made in a pass or a few and ends where ranges are small; what is
moved grows with the difference, not with the sides.

A range is named by the leading hexadecimal digits of its ids' keys: 8 for the
second, then 16 of the id's hash. So ranges are stretches of time, then, within
one second, of hashes, however the events crowd.

* Rows that repeat count once. Null ids or times take no part.
* Two sides without a difference move the topmost fingerprint only. An empty
  side differs wherever the other has ids.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Ranges that a range is cut into (a hexadecimal digit), digits of a key, ids that are moved rather than compared further.
FAN, DIGITS, FEW = 16, 24, 32
#: Levels of a tree that one pass makes.
STEP = 6
LARGEST_SECOND = (1 << 32) - 1


@dataclass
class Reconciled:
    """What one side lacks (id, created_at), and what was moved: by level, ranges compared, ranges that differ, ids moved."""

    missing: DataFrame
    moved: list[dict]

    def ids_moved(self) -> int:
        return sum(level["ids"] for level in self.moved)


def keyed(side: DataFrame) -> DataFrame:
    """id, created_at and key of the different ids within 32-bit seconds."""
    own = side.where(F.col("id").isNotNull() & F.col("created_at").between(0, LARGEST_SECOND)).select("id", F.col("created_at").cast("bigint").alias("created_at")).distinct()
    hexed = lambda c, n: F.lower(F.lpad(F.hex(c), n, "0"))
    return own.withColumn("key", F.concat(hexed(F.col("created_at"), 8), hexed(F.xxhash64("id"), 16)))


def grow(side: DataFrame, path: str, few: int = FEW, top: int = 0) -> DataFrame:
    """level, range, n, a and b (the fingerprint) of the ranges that hold ids, below others only where these hold more than ``few``; written to path.

    ``STEP`` levels are made in one pass, the ones below by the ids in ranges that are still too full.
    """
    spark = side.sparkSession
    rows = side.select("key", F.xxhash64("id", "created_at").alias("a"), F.xxhash64(F.lit(1), "created_at", "id").alias("b"))
    while True:
        last = min(top + STEP, DIGITS)
        levels = F.explode(F.sequence(F.lit(top), F.lit(last))).alias("level")
        ranges = rows.select(levels, "key", "a", "b").select("level", F.expr("substring(key, 1, level)").alias("range"), "a", "b")
        ranges.groupBy("level", "range").agg(F.count("*").alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).write.mode("append").partitionBy("level").parquet(path)
        summed = spark.read.schema("range string, n long, a long, b long, level int").parquet(path)
        full = summed.where((F.col("level") == last) & (F.col("n") > few)).select("range")
        if last == DIGITS or full.isEmpty():
            return summed
        rows, top = rows.withColumn("range", F.substring("key", 1, last)).join(full, "range", "left_semi").drop("range"), last + 1


def reconcile(ours: DataFrame, theirs: DataFrame, work: str, few: int = FEW) -> Reconciled:
    """The ids of theirs that ours lack. ``work``: a folder that driver and executors share, for the two trees."""
    spark = ours.sparkSession
    sides = {"ours": keyed(ours), "theirs": keyed(theirs)}
    # The topmost range is what all ids of both sides share.
    ends = [x for side in sides.values() for x in side.agg(F.min("key"), F.max("key")).first() if x is not None]
    top = os.path.commonprefix(ends)
    trees = {name: grow(side, f"{work}/{name}", few, len(top)) for name, side in sides.items()}
    asked, settled, moved = spark.createDataFrame([(top,)], "range string"), [], []
    for level in range(len(top), DIGITS + 1):
        # Both sides' fingerprints of the ranges that are asked for; one that holds nothing has none.
        left, right = (trees[name].where(F.col("level") == level).select("range", F.struct("n", "a", "b").alias(name)) for name in sides)
        met = asked.join(left, "range", "left").join(right, "range", "left").withColumn("same", F.col("ours").eqNullSafe(F.col("theirs")))
        met.write.parquet(f"{work}/met/level={level}")
        met = spark.read.parquet(f"{work}/met/level={level}")
        small = (F.coalesce(F.col("ours.n"), F.lit(0)) <= few) | (F.coalesce(F.col("theirs.n"), F.lit(0)) <= few) if level < DIGITS else F.lit(True)
        differ, held = met.where("NOT same"), F.coalesce(F.col("ours.n"), F.lit(0)) + F.coalesce(F.col("theirs.n"), F.lit(0))
        n = met.agg(F.count("*").alias("compared"), F.count_if(~F.col("same")).alias("differ"), F.coalesce(F.sum(F.when(~F.col("same") & small, held)), F.lit(0)).alias("ids"), F.count_if(~F.col("same") & ~small).alias("open")).first()
        moved.append({"level": level, "compared": n.compared, "differ": n.differ, "ids": n.ids})
        settled.append(differ.where(small).select(F.lit(level).alias("level"), "range"))
        if not n.open:
            break
        digits = F.explode(F.array(*[F.lit(f"{d:x}") for d in range(FAN)]))
        asked = differ.where(~small).select("range", digits.alias("d")).select(F.concat("range", "d").alias("range"))
    ranges = settled[0]
    for more in settled[1:]:
        ranges = ranges.unionAll(more)
    # One look at a side's keys for each level that has settled ranges, in one join.
    deep = [m["level"] for m in moved if m["ids"]]
    cut = F.explode(F.array(*[F.struct(F.lit(x).alias("level"), F.substring("key", 1, x).alias("range")) for x in deep])) if deep else None
    if cut is None:
        return Reconciled(sides["theirs"].select("id", "created_at").limit(0), moved)
    of = lambda side: side.select("id", "created_at", cut.alias("r")).select("id", "created_at", "r.level", "r.range").join(ranges, ["level", "range"], "left_semi").select("id", "created_at")
    return Reconciled(of(sides["theirs"]).join(of(sides["ours"]), ["id", "created_at"], "left_anti"), moved)
