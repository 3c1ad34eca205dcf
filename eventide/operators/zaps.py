"""Statistics of zaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions import time as tm
from eventide.schema import DAY

# Upper ends of the histogram's buckets in sats, and the buckets' names.
BOUNDS = [10, 21, 50, 100, 250, 500, 750, 1000, 2500, 5000, 7500, 10_000, 25_000, 50_000, 75_000, 100_000]
NAMES = [
    "1-10 sats", "11-21 sats", "22-50 sats", "51-100 sats", "101-250 sats", "251-500 sats", "501-750 sats", "751-1K sats", "1K-2.5K sats",
    "2.5K-5K sats", "5K-7.5K sats", "7.5K-10K sats", "10K-25K sats", "25K-50K sats", "50K-75K sats", "75K-100K sats", "100K+ sats",
]
OPEN_END = 999_999_999


def _sats(msats: Column) -> Column:
    """Whole sats, in integers."""
    return F.call_function("div", msats, F.lit(1000)).cast("bigint")


def _window(zaps: DataFrame, as_of: int, days: int) -> DataFrame:
    return zaps.where((F.col("created_at") >= as_of - days * DAY) & (F.col("amount_msats") > 0))


def totals(zaps: DataFrame, as_of: int, days: int = 30) -> DataFrame:
    amount = F.col("amount_msats")
    return _window(zaps, as_of, days).agg(
        F.count("*").alias("total_zaps"), _sats(F.coalesce(F.sum(amount), F.lit(0))).alias("total_sats"), F.count_distinct("zapper_pubkey").alias("unique_zappers"), F.count_distinct("recipient_pubkey").alias("unique_recipients"), (F.avg(amount) / 1000).alias("avg_sats"), (F.median(amount) / 1000).alias("median_sats")
    )


def by_period(zaps: DataFrame, as_of: int, grain: str, days: int, limit: int) -> DataFrame:
    amount = F.col("amount_msats")
    out = _window(zaps, as_of, days).groupBy(tm.bucket("created_at", grain).alias("p")).agg(
        F.count("*").alias("zap_count"), _sats(F.sum(amount)).alias("total_sats"), F.count_distinct("zapper_pubkey").alias("unique_zappers"), (F.avg(amount) / 1000).alias("avg_sats")
    )
    return out.orderBy(F.desc("p")).limit(limit).select(tm.shown(F.col("p")).alias("period"), "zap_count", "total_sats", "unique_zappers", "avg_sats")


def histogram(zaps: DataFrame, as_of: int, days: int = 30) -> DataFrame:
    """Counts and sums by bucket of the amount, ends included, with shares of all; the totals come from the buckets, not from a second scan."""
    n = len(BOUNDS)
    place = F.lit(n)
    for i in reversed(range(n)):
        place = F.when(F.col("amount_msats") <= BOUNDS[i] * 1000, i).otherwise(place)
    buckets = _window(zaps, as_of, days).groupBy(place.alias("i")).agg(F.count("*").alias("count"), F.sum("amount_msats").alias("msats"))
    all_ = buckets.agg(F.sum("count").alias("all_count"), F.sum("msats").alias("all_msats"))
    lit = lambda xs: F.array(*[F.lit(x) for x in xs])
    pct = lambda part, whole: F.coalesce(F.round(F.try_divide(F.col(part) * 100.0, F.col(whole)), 2), F.lit(0.0))
    # One row beside 17 at most.
    return buckets.join(F.broadcast(all_)).select(
        F.get(lit(NAMES), F.col("i")).alias("bucket"), F.get(lit([1] + [b + 1 for b in BOUNDS]), F.col("i")).cast("bigint").alias("min_sats"), F.get(lit([*BOUNDS, OPEN_END]), F.col("i")).cast("bigint").alias("max_sats"),
        "count", _sats(F.col("msats")).alias("total_sats"), pct("count", "all_count").alias("pct_count"), pct("msats", "all_msats").alias("pct_sats"),
    )


def for_target(zaps: DataFrame, events: DataFrame, target: str) -> DataFrame:
    """Count and sats of the zaps whose receipt names the target event."""
    from eventide.functions import tags as tg

    receipts = events.where(F.array_contains(tg.values(F.col("tags"), "e"), target)).select(F.col("id").alias("event_id"))
    return zaps.join(receipts, "event_id", "left_semi").agg(F.count("*").alias("zap_count"), _sats(F.coalesce(F.sum("amount_msats"), F.lit(0))).alias("zap_sats"))
