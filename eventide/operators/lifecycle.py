"""Building, advancing and checking the archive's products."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators import rollups as ro
from eventide.schema import LARGEST_API_SECOND


def reject_conflicts(events: DataFrame) -> None:
    """ValueError if an id stands with different committed fields."""
    found = ro.conflicts(events).orderBy("id").limit(5).collect()
    if found:
        raise ValueError(f"conflicting events: {[r['id'] for r in found]}")


@dataclass
class Products:
    """Canonical events (id, created_at, kind) and the rollups over them."""

    canonical: DataFrame
    daily: DataFrame
    daily_kind: DataFrame
    kinds: DataFrame
    physical: int

    def accounting(self) -> DataFrame:
        """One row: physical, logical, duplicate and representable events."""
        shown = F.count_if(F.col("created_at") <= LARGEST_API_SECOND)
        return self.canonical.agg(F.lit(self.physical).cast("bigint").alias("physical"), F.count("*").alias("logical"), (F.lit(self.physical) - F.count("*")).cast("bigint").alias("duplicate"), shown.alias("representable"))


def build(events: DataFrame) -> Products:
    """All products of a snapshot; conflicts stop it."""
    reject_conflicts(events)
    canonical = ro.distinct_events(events)
    return Products(canonical, ro.daily(canonical), ro.daily_kind(canonical), ro.kind_all_time(canonical), events.count())


def apply_delta(base: Products, added: DataFrame) -> Products:
    """Products with added objects: only new events are counted, rollups are added up; what is applied twice changes nothing.

    Matching goes by id alone, so an id whose fields differ is found and stops it.
    """
    delta = ro.distinct_events(added)
    reject_conflicts(delta)
    both = delta.join(base.canonical.select("id", F.col("created_at").alias("c"), F.col("kind").alias("k")), "id")
    wrong = both.where("NOT (created_at <=> c AND kind <=> k)").orderBy("id").limit(5).collect()
    if wrong:
        raise ValueError(f"conflicting events: {[r['id'] for r in wrong]}")
    fresh = delta.join(base.canonical.select("id"), "id", "left_anti").select("id", "created_at", "kind")
    return advanced(base, fresh, added.count())


def advanced(base: Products, fresh: DataFrame, physical: int) -> Products:
    """Products with events that are new to them, of so many physical rows."""
    canonical = base.canonical.select("id", "created_at", "kind").unionByName(fresh)
    return Products(canonical, ro.additive(base.daily, ro.daily(fresh)), ro.additive(base.daily_kind, ro.daily_kind(fresh)), ro.additive(base.kinds, ro.kind_all_time(fresh)), base.physical + physical)


def check(products: Products) -> dict[str, int]:
    """Accounting of the products; ValueError where they don't add up."""
    a = products.accounting().first().asDict()
    total = lambda df: df.agg(F.coalesce(F.sum("event_count"), F.lit(0)).cast("bigint")).first()[0]
    a |= {"daily_sum": total(products.daily), "daily_kind_sum": total(products.daily_kind), "kind_sum": total(products.kinds)}
    wrong = [n for n, ok in {
        "physical": a["physical"] == a["logical"] + a["duplicate"], "duplicate": a["duplicate"] >= 0, "daily": a["daily_sum"] == a["representable"],
        "daily_kind": a["daily_kind_sum"] == a["representable"], "kinds": a["kind_sum"] == a["logical"],
    }.items() if not ok]
    if wrong:
        raise ValueError(f"products don't add up: {wrong} in {a}")
    return a


# Comparisons.


def compare_series(left: DataFrame, right: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Keys with both values and a class: equal, different, only_left or only_right."""
    l, r = left.select(*keys, F.col(value).alias("left_value"), F.lit(1).alias("_l")), right.select(*keys, F.col(value).alias("right_value"), F.lit(1).alias("_r"))
    both = l.join(r, keys, "full_outer")
    kind = F.when(F.col("_r").isNull(), "only_left").when(F.col("_l").isNull(), "only_right").when(F.col("left_value").eqNullSafe(F.col("right_value")), "equal").otherwise("different")
    return both.select(*keys, "left_value", "right_value", kind.alias("class"))


def compare_summary(compared: DataFrame) -> DataFrame:
    n = lambda c: F.count_if(F.col("class") == c).alias(c)
    return compared.agg(F.count("*").alias("keys"), n("equal"), n("different"), n("only_left"), n("only_right"))


def compare_scalars(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two rows of numbers by name: name, both values, their difference and a class; a name on one side only has null on the other."""

    def named(df: DataFrame, value: str) -> DataFrame:
        each = [F.struct(F.lit(c).alias("name"), F.col(c).cast("decimal(38,6)").alias(value)) for c in df.columns]
        return df.limit(1).select(F.explode(F.array(*each)).alias("x")).select("x.*")

    both = compare_series(named(left, "v"), named(right, "v"), ["name"], "v")
    return both.select("name", "left_value", "right_value", (F.col("right_value") - F.col("left_value")).alias("difference"), "class")


def residual(missing: DataFrame, versions: DataFrame, live_since: int) -> DataFrame:
    """Each missing id with what the other store knows of it, and a class.

    versions: id, created_at, kind, indexed_at and source of every stored
    version. The newest version's fields count, and when the first came:
    before_live if that was before both stores were fed alike (a divergence of
    old), after_live if not (an omission since), unknown if no version is known.
    """
    newest = lambda c: F.max_by(c, F.struct("indexed_at", "created_at", "kind")).alias(c)
    own = versions.join(missing.select("id").distinct(), "id", "left_semi").groupBy("id").agg(newest("created_at"), newest("kind"), newest("source"), F.min("indexed_at").alias("first_indexed_at"), F.max("indexed_at").alias("last_indexed_at"), F.count("*").alias("versions"))
    kind = F.when(F.col("versions").isNull(), "unknown").when(F.col("first_indexed_at") < live_since, "before_live").otherwise("after_live")
    return missing.select("id").distinct().join(own, "id", "left").withColumn("class", kind)


def residual_summary(classed: DataFrame) -> DataFrame:
    """By class: ids, their share in percent, stored versions, and the time between event and first index, the middle one and the longest."""
    late = F.col("first_indexed_at") - F.col("created_at")
    own = classed.groupBy("class").agg(F.count("*").alias("ids"), F.coalesce(F.sum("versions"), F.lit(0)).cast("bigint").alias("versions"), F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY first_indexed_at - created_at)").alias("late_p50"), F.max(late).alias("late_max"))
    # One row of totals.
    return own.join(F.broadcast(own.agg(F.sum("ids").alias("all")))).withColumn("percent", F.col("ids") * 100.0 / F.col("all")).drop("all")


def attribution(classed: DataFrame, by: str) -> DataFrame:
    """How many of the ids fall on each value of a column, by class."""
    return classed.groupBy("class", F.col(by).cast("string").alias("value")).agg(F.count("*").alias("ids"))


def examples(compared: DataFrame, n: int = 20) -> DataFrame:
    """The first differences by key."""
    keys = [c for c in compared.columns if c not in ("left_value", "right_value", "class")]
    return compared.where("class <> 'equal'").orderBy(*keys).limit(n)


def series_digest(df: DataFrame, key: Column, value: Column, shards: int = 256) -> DataFrame:
    """SHA-256 over the sorted lines key, zero byte, value, of each shard of keys, then over the shards': no task holds all lines."""
    line = F.concat(key.cast("string"), F.lit("\0"), value.cast("string"), F.lit("\n"))
    parts = df.select(line.alias("line"), F.pmod(F.xxhash64(key.cast("string")), F.lit(shards)).alias("shard")).groupBy("shard")
    hashed = parts.agg(F.sha2(F.array_join(F.array_sort(F.collect_list("line")), ""), 256).alias("digest"))
    return hashed.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("shard", "digest"))), lambda x: x["digest"]), ""), 256).alias("digest"))


def small_series_digest(df: DataFrame, key: Column, value: Column) -> DataFrame:
    """The same as one SHA-256, for series of a few thousand keys such as days."""
    line = F.concat(key.cast("string"), F.lit("\0"), value.cast("string"), F.lit("\n"))
    return df.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), ""), 256).alias("digest"))


def gate(aligned: bool, differences: int) -> str:
    """passed or failed; incomplete while it isn't proven that both sides had the same input."""
    return "incomplete" if not aligned else "failed" if differences else "passed"


def classify(equal: bool, aligned: bool) -> str:
    return "exact" if equal else "bug" if aligned else "uncertainty"


def shard_compare(left: DataFrame, right: DataFrame, id_hex: Column, digits: int = 2) -> DataFrame:
    """By prefix of the id: rows on both sides and whether the id sets are equal; one pass for all shards."""
    sums = lambda df, s: df.select(F.substring(id_hex, 1, digits).alias("shard"), F.xxhash64(id_hex).alias("h")).groupBy("shard").agg(F.count("*").alias(f"{s}_rows"), F.bit_xor("h").alias(f"{s}_hash"))
    both = sums(left, "left").join(sums(right, "right"), "shard", "full_outer").fillna(0, ["left_rows", "right_rows"])
    return both.select("shard", "left_rows", "right_rows", (F.col("left_hash").eqNullSafe(F.col("right_hash")) & (F.col("left_rows") == F.col("right_rows"))).alias("equal"))


def align(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every id with the sides that have it."""
    both = left.select("id").distinct().withColumn("l", F.lit(1)).join(right.select("id").distinct().withColumn("r", F.lit(1)), "id", "full_outer")
    return both.select("id", F.when(F.col("r").isNull(), "only_left").when(F.col("l").isNull(), "only_right").otherwise("both").alias("side"))


def attribute(missing: DataFrame, lake: DataFrame, catalog: DataFrame) -> DataFrame:
    """Missing ids with the objects that hold them, through each row's file; ids in no object have a null key.

    lake: id and file; catalog: object_key and file.
    """
    held = lake.join(missing.select("id"), "id", "left_semi").join(catalog.select("object_key", "file"), "file", "left").select("id", "object_key").distinct()
    return missing.select("id").join(held, "id", "left")


def missing_rows(source: DataFrame, outputs: DataFrame) -> DataFrame:
    return source.join(outputs.select("id"), "id", "left_anti")


def equal_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Counts of rows on one side only, repeats counted."""
    n = lambda x, y, s: x.exceptAll(y.select(x.columns)).agg(F.count("*").alias(s))
    return n(a, b, "only_left").join(F.broadcast(n(b.select(a.columns), a, "only_right")))


def order_violations(rows: DataFrame, part: str, *keys: str) -> DataFrame:
    """Rows of each part that don't come behind the row before them by (row_nr); equal keys break the order too."""
    own = F.struct(*keys)
    before = F.lag(own).over(Window.partitionBy(part).orderBy("row_nr"))
    return rows.withColumn("_before", before).where(F.col("_before") >= own).drop("_before")


def sync_missing(ours: DataFrame, theirs: DataFrame, as_of: int, lookback: int) -> DataFrame:
    """Ids of a peer's window that we lack, to be fetched."""
    own = lambda df: df.where(F.col("created_at") >= as_of - lookback).select("id", "created_at")
    return own(theirs).join(own(ours).select("id"), "id", "left_anti")


def prune_sync(state: DataFrame, archived: DataFrame, as_of: int, lookback: int) -> DataFrame:
    """State of the next round: ids within the lookback that are archived."""
    return state.where(F.col("created_at") >= as_of - lookback).join(archived.select("id"), "id", "left_semi")


def sampled(events: DataFrame, id_hex: Column, rate: float) -> DataFrame:
    """A fixed share of events by the first byte of their id."""
    threshold = int(min(max(rate, 0.0), 1.0) * 256 + 0.5)
    return events.where(F.conv(F.substring(id_hex, 1, 2), 16, 10).cast("int") < threshold)


def coverage(sample: DataFrame, known: DataFrame, references: DataFrame) -> DataFrame:
    """References of sampled events, and how many of the named events are known."""
    own = references.join(sample.select("id"), "id", "left_semi")
    there = own.join(known.select(F.lower(F.col("id").cast("string")).alias("reference"), F.lit(1).alias("_known")).distinct(), "reference", "left")
    return there.agg(F.count("*").alias("referenced"), F.count("_known").alias("present")).withColumn("coverage", F.coalesce(F.try_divide(F.col("present").cast("double"), F.col("referenced")), F.lit(0.0)))
