"""A comparison of two sides' ids that can be stopped and goes on: by prefixes of the id, refined where they differ.

Every prefix that is dealt with has a small file of its own: equal, refined
(its longer prefixes are looked at), or differs (its ids on one side only are
written). A run reads the rows of prefixes without a file once and lays them out
in ranges of ids; it takes so many of these prefixes a round, reads only their
ranges, and writes the files. What a run before has finished isn't read again.

* Ids are lower-case hexadecimal strings. Rows that repeat count once; null ids don't count.
* Sides that change between runs are compared as each run finds them.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators.catalog import canonical_json
from eventide.operators.publish import Store

#: Rows of a prefix on both sides together up to which its ids are written rather than the prefix refined; prefixes of a round.
FEW, ROUND = 10_000, 64
#: Prefixes that a scan is asked for by name, and those that rounds without a limit take together.
MANY, MOST = 512, 4096
DIGITS = "0123456789abcdef"


def _under(prefixes: list[str]) -> Column:
    """Ids of the prefixes, as ranges that a scan can use; of very many, all that stand between the first and the last."""
    if len(prefixes) > MANY:
        return (F.col("id") >= prefixes[0]) & (F.col("id") < prefixes[-1] + "g")
    parts = [(F.col("id") >= p) & (F.col("id") < p + "g") for p in prefixes]
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return out


def finished(spark: SparkSession, work: str) -> dict[str, dict]:
    """What is known of each prefix so far."""
    store = Store(spark, work)
    return {d["prefix"]: d for d in (json.loads(store.read(f"prefixes/{n}")) for n in store.names("prefixes") if n.endswith(".json"))}


def open_prefixes(known: dict[str, dict], digits: int) -> list[str]:
    """Prefixes that have still to be looked at, in order."""
    todo, out = [""], []
    for _ in range(digits):
        todo = [p + d for p in todo for d in DIGITS]
    while todo:
        p = todo.pop()
        if p not in known:
            out.append(p)
        elif known[p]["state"] == "refined":
            todo += [p + d for d in DIGITS]
    return sorted(out)


def _stage(left: DataFrame, right: DataFrame, prefixes: list[str], path: str) -> None:
    """id, l and r (whether a side has it) of the ids under the prefixes, in ranges of ids, so that a round reads its own."""
    within = _under(prefixes)
    side = lambda df, l: df.select(F.col("id").cast("string").alias("id")).where(F.col("id").isNotNull() & within).select("id", F.lit(l).alias("l"))  # noqa: E731, E741
    both = side(left, True).unionAll(side(right, False)).groupBy("id").agg(F.bool_or("l").alias("l"), F.bool_or(~F.col("l")).alias("r"))
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both.repartitionByRange(parts, "id").sortWithinPartitions("id").write.mode("overwrite").option("parquet.block.size", 8 << 20).parquet(path)


def compare(left: DataFrame, right: DataFrame, work: str, digits: int = 1, few: int = FEW, rounds: int | None = None, at_once: int = ROUND) -> bool:
    """Go on with the comparison in ``work``; True once no prefix is open. ``rounds``: stop after so many, of ``at_once`` prefixes; without it, prefixes of one length are taken by MOST or more together."""
    spark, store = left.sparkSession, Store(left.sparkSession, work)
    known, staged = finished(spark, work), False
    while (todo := open_prefixes(known, digits)) and (rounds is None or rounds > 0):
        own = [p for p in todo if len(p) == len(todo[0])][: max(at_once, MOST) if rounds is None else at_once]
        if not staged:
            # A run reads the sides once, its last round's rows only where it has no other.
            _stage(left, right, own if rounds == 1 else todo, f"{work}/rows")
            staged = True
        rounds = None if rounds is None else rounds - 1
        rows = spark.read.schema("id string, l boolean, r boolean").parquet(f"{work}/rows").where(_under(own))
        rows = rows.withColumn("prefix", F.substring("id", 1, len(own[0])))
        rows = rows.where(F.col("prefix").isin(own))
        # A row for each prefix taken.
        sums = rows.groupBy("prefix").agg(F.count_if("l").alias("n_l"), F.count_if("r").alias("n_r"), F.count_if(F.col("l") != F.col("r")).alias("alone"))
        found = {r["prefix"]: r for r in sums.collect()}
        states, write = {}, []
        for p in own:
            r = found.get(p)
            n = (0, 0) if r is None else (r["n_l"], r["n_r"])
            state = "equal" if r is None or not r["alone"] else "differs" if sum(n) <= few else "refined"
            states[p] = {"prefix": p, "state": state, "left_rows": n[0], "right_rows": n[1]}
            write += [p] if state == "differs" else []
        if write:
            alone = rows.where((F.col("l") != F.col("r")) & F.col("prefix").isin(write)).select("id", F.when(F.col("l"), "only_left").otherwise("only_right").alias("side"), "prefix")
            # Written before the files of their prefixes; a run that ends in between writes them anew.
            alone.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("prefix").parquet(f"{work}/differences")
        for p, x in states.items():
            store.write(f"prefixes/{p}.json", canonical_json(x), replace=True)
        known |= states
    return not open_prefixes(known, digits)


def differences(spark: SparkSession, work: str) -> DataFrame:
    """id and side of the ids that one side has alone, of the prefixes that are finished."""
    own = [p for p, s in finished(spark, work).items() if s["state"] == "differs"]
    if not own:
        return spark.createDataFrame([], "id string, side string")
    rows = spark.read.schema("id string, side string, prefix string").option("basePath", f"{work}/differences").parquet(*[f"{work}/differences/prefix={p}" for p in own])
    return rows.select("id", "side")
