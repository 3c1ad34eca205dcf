"""Daily user statistics, active and new users, cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions import time as tm
from eventide.schema import DAY, FOLLOWS, GENESIS, PROFILE, THROWAWAY_KINDS


def daily_user_stats(events: DataFrame, throwaway: tuple[int, ...] = THROWAWAY_KINDS) -> DataFrame:
    """date, pubkey, event_count, and whether the author ever posted a profile or a follow list.

    Grouped by author and day first; the flags are then an aggregate over the
    author's days, so the events are read and shuffled once.
    """
    mark = lambda kind: F.max(F.when(F.col("kind") == kind, 1).otherwise(0))
    days = events.groupBy("pubkey", tm.day("created_at").alias("date")).agg(F.count_if(~F.col("kind").isin(*throwaway)).alias("event_count"), mark(PROFILE).alias("p"), mark(FOLLOWS).alias("f"))
    flags = days.groupBy("pubkey").agg((F.max("p") == 1).alias("has_profile"), (F.max("f") == 1).alias("has_follows"))
    return days.where("event_count > 0").join(flags, "pubkey").select("date", "pubkey", "has_profile", "has_follows", "event_count")


def active_users(stats: DataFrame, grain: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Distinct users of each period, recomputed from (day, user) rows: counts of days don't add up."""
    own = stats if first is None else stats.where(F.col("date") >= F.lit(first).cast("date"))
    own = own if last is None else own.where(F.col("date") <= F.lit(last).cast("date"))
    per_user = own.groupBy(tm.of_date(F.col("date"), grain).alias("p"), "pubkey").agg(F.first("has_profile").alias("hp"), F.first("has_follows").alias("hf"), F.sum("event_count").alias("n"))
    return per_user.groupBy("p").agg(
        F.count("*").alias("active_users"), F.count_if("hp").alias("has_profile"), F.count_if("hf").alias("has_follows"), F.count_if(F.col("hp") & F.col("hf")).alias("has_both"), F.sum("n").cast("bigint").alias("total_events")
    ).select(tm.shown(F.col("p")).alias("period"), "active_users", "has_profile", "has_follows", "has_both", "total_events")


def periods(stats: DataFrame, grain: str) -> DataFrame:
    """Events and distinct users of each period, from (day, user) rows: period, count, unique_pubkeys."""
    per_user = stats.groupBy(tm.of_date(F.col("date"), grain).alias("p"), "pubkey").agg(F.sum("event_count").alias("n"))
    out = per_user.groupBy("p").agg(F.sum("n").cast("bigint").alias("count"), F.count("*").alias("unique_pubkeys"))
    return out.select(tm.shown(F.col("p")).alias("period"), "count", "unique_pubkeys")


def latest_active_users(stats: DataFrame, last: str) -> DataFrame:
    """The latest day, week and month, a row each."""
    rows = None
    for grain in ("day", "week", "month"):
        one = active_users(stats, grain, last=last).orderBy(F.desc("period")).limit(1).select(F.lit(grain).alias("grain"), "*")
        rows = one if rows is None else rows.unionByName(one)
    return rows


def first_seen(events: DataFrame, throwaway: tuple[int, ...] = THROWAWAY_KINDS) -> DataFrame:
    return events.where(~F.col("kind").isin(*throwaway)).groupBy("pubkey").agg(F.min("created_at").alias("first_seen"))


def eligible(seen: DataFrame, as_of: int) -> DataFrame:
    """First sights from the first day that counts up to as_of; an author first seen outside isn't new ever."""
    return seen.where(F.col("first_seen").between(GENESIS, as_of))


def advance(seen: DataFrame, delta: DataFrame) -> DataFrame:
    """First sights with those of a delta: late events move an author to an earlier day."""
    return seen.unionByName(delta).groupBy("pubkey").agg(F.min("first_seen").alias("first_seen"))


def new_users(seen: DataFrame, as_of: int, grain: str = "day") -> DataFrame:
    return eligible(seen, as_of).groupBy(tm.bucket("first_seen", grain).alias("p")).agg(F.count("*").alias("new_users")).select(tm.shown(F.col("p")).alias("period"), "new_users")


def cohorts(stats: DataFrame, seen: DataFrame, grain: str) -> DataFrame:
    """Users of each cohort (period of the first sight) that were active in each period: cohort, activity_period, active_count.

    Days are narrowed to one row for each user and period before the join.
    """
    own = seen.where(F.col("first_seen") >= 0).select("pubkey", tm.day("first_seen").alias("since"))
    cohort = tm.of_date(F.col("since"), grain)
    days = stats.select("pubkey", "date")
    joined = days.join(own, "pubkey").where(F.col("since") <= F.col("date")).where(cohort >= F.date_from_unix_date(F.lit(GENESIS // DAY)))
    periods = joined.select("pubkey", cohort.alias("c"), tm.of_date(F.col("date"), grain).alias("a")).distinct()
    return periods.groupBy("c", "a").agg(F.count("*").alias("active_count")).select(tm.shown(F.col("c")).alias("cohort"), tm.shown(F.col("a")).alias("activity_period"), "active_count")


def retention(table: DataFrame, first: Column | str | None = None, limit: int | None = None, oldest_present_is_size: bool = False) -> DataFrame:
    """A row for each cohort: its size, active counts in order of period, and these in percent of the size.

    The size is the count of the period that is the cohort's own, 0 if there is
    none (percentages are then 0); oldest_present_is_size takes the first
    period present instead. The oldest cohorts come first and are kept.
    """
    own = table if first is None else table.where(F.col("cohort") >= F.lit(first))
    pairs = F.array_sort(F.collect_list(F.struct("activity_period", "active_count")))
    grouped = own.groupBy("cohort").agg(pairs.alias("x"))
    at_home = F.coalesce(F.get(F.filter("x", lambda p: p["activity_period"] == F.col("cohort")), F.lit(0))["active_count"], F.lit(0))
    size = F.get(F.col("x"), F.lit(0))["active_count"] if oldest_present_is_size else at_home
    out = grouped.select("cohort", size.cast("bigint").alias("cohort_size"), F.transform("x", lambda p: p["active_count"]).alias("retention"))
    out = out.withColumn("retention_pct", F.transform("retention", lambda n: F.coalesce(F.try_divide(n * 100.0, F.col("cohort_size")), F.lit(0.0))))
    return out.orderBy("cohort").limit(limit) if limit else out
