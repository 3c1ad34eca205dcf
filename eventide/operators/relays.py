"""Relays: distribution over users, scores, listings, swaps, catalog targets, connection states."""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions import tags as tg
from eventide.functions import text as tx
from eventide.functions import time as tm
from eventide.operators.engagement import latest
from eventide.operators.rollups import choice, limits
from eventide.schema import DAY, HOUR, RELAY_LIST, WEEK
from eventide.session import shared

# Fixed values of scoring.
NOVEL_WEIGHT, UPTIME_WEIGHT, NOVEL_CAP, SEED_FLOOR = 0.7, 0.3, 2.0, 0.5
STATUSES = ("active", "blocked", "failing", "idle", "pending")


def distribution(events: DataFrame, least_users: int = 10) -> DataFrame:
    """Users of each relay by their newest lists; a relay that a list names twice counts twice."""
    lists = latest(events.where(F.col("kind") == RELAY_LIST).select("id", "pubkey", "created_at", "tags"), "pubkey")
    r = lists.select(F.explode(F.filter("tags", lambda t: (F.size(t) >= 2) & (F.get(t, F.lit(0)) == "r"))).alias("t"))
    named = r.select(tx.plain_relay_url(F.get("t", F.lit(1))).alias("relay_url"), tg.at(F.col("t"), 2).alias("marker")).where(tx.plausible_relay_url(F.col("relay_url")))
    marked = lambda m: F.count_if(F.col("marker").isin("", m))
    return named.groupBy("relay_url").agg(F.count("*").alias("user_count"), marked("read").alias("read_count"), marked("write").alias("write_count")).where(F.col("user_count") >= least_users)


def scores(relays: DataFrame, hourly: DataFrame, as_of: int) -> DataFrame:
    """Scores of relays that aren't blocked, from one pass over a week of hourly statistics."""
    h = F.col("hour_start")
    day, hour = h >= as_of - DAY, h >= as_of - HOUR
    sums = hourly.where(h >= as_of - WEEK).groupBy("relay_url").agg(
        F.sum(F.when(hour, F.col("events_novel"))).alias("n1"), F.sum(F.when(day, F.col("events_novel"))).alias("n24"), F.count_distinct(F.when(day, h)).alias("h24"), F.sum("events_novel").alias("n7"), F.count_distinct(h).alias("h7"),
        F.sum(F.when(day, F.col("connection_attempts"))).alias("a24"), F.sum(F.when(day, F.col("connection_successes"))).alias("s24"), F.sum("connection_attempts").alias("a7"), F.sum("connection_successes").alias("s7"),
    )
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    own = relays.where("status <> 'blocked'").select("url", "tier").join(sums, F.col("url") == F.col("relay_url"), "left")
    rates = own.select(
        F.col("url").alias("relay_url"), "tier", F.coalesce(F.col("n1").cast("double"), F.lit(0.0)).alias("novel_rate_1h"), per("n24", "h24").alias("novel_rate_24h"), per("n7", "h7").alias("novel_rate_7d"), per("s24", "a24").alias("uptime_24h"), per("s7", "a7").alias("uptime_7d")
    )
    middle = rates.agg(F.median("novel_rate_7d").alias("m")).select(F.when(F.col("m") > 0, F.col("m")).otherwise(1.0).alias("m"))
    raw = F.least(F.col("novel_rate_7d") / F.col("m"), F.lit(NOVEL_CAP)) * NOVEL_WEIGHT + F.least(F.greatest("uptime_7d", F.lit(0.0)), F.lit(1.0)) * UPTIME_WEIGHT
    # The median is one row.
    scored = rates.join(F.broadcast(middle)).withColumn("score", F.when(F.col("tier") == "seed", F.greatest(raw, F.lit(SEED_FLOOR))).otherwise(raw))
    return scored.select("relay_url", "score", "novel_rate_1h", "novel_rate_24h", "novel_rate_7d", "uptime_24h", "uptime_7d")


def summary(relays: DataFrame, hourly: DataFrame, as_of: int) -> DataFrame:
    """Counts by status, and the last complete hour."""
    start, end = tm.previous_hour(as_of)
    counts = relays.agg(F.count("*").alias("total_discovered"), *[F.count_if(F.col("status") == s).alias(f"total_{s}") for s in STATUSES])
    sum_of = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    hour = hourly.where((F.col("hour_start") >= start) & (F.col("hour_start") < end)).agg(sum_of("events_received").alias("events_last_hour"), sum_of("events_novel").alias("novel_events_last_hour"))
    return counts.join(F.broadcast(hour)).withColumn("avg_events_per_minute", F.col("events_last_hour") / 60.0)


def listing(relays: DataFrame, scored: DataFrame, hourly: DataFrame, as_of: int, status: str | None = None, tier: str | None = None, sort_by: str = "score", order: str = "desc", limit: int | None = None, offset: int = 0) -> DataFrame:
    """A page of relays; ties are in order of URL."""
    start, end = tm.previous_hour(as_of)
    hour = hourly.where((F.col("hour_start") >= start) & (F.col("hour_start") < end)).groupBy("relay_url").agg(F.sum("events_received").cast("bigint").alias("r"), F.sum("events_novel").cast("bigint").alias("n"))
    own = relays
    for name, value in (("status", status), ("tier", tier)):
        own = own if value is None else own.where(F.col(name) == value)
    out = own.join(scored.select(F.col("relay_url").alias("u1"), "score"), F.col("url") == F.col("u1"), "left").join(hour.withColumnRenamed("relay_url", "u2"), F.col("url") == F.col("u2"), "left")
    out = out.select("url", "status", "tier", "score", F.coalesce("r", F.lit(0)).alias("events_last_hour"), F.coalesce("n", F.lit(0)).alias("novel_events_last_hour"))
    key = choice(sort_by, {"score": F.coalesce("score", F.lit(0.0)), "events": F.col("events_last_hour"), "url": F.col("url")})
    ranked = out.orderBy(key.asc() if choice(order, {"asc": "asc", "desc": "desc"}) == "asc" else key.desc(), "url")
    return ranked.offset(offset).limit(limits(limit, 100, 1000))


def listing_with_total(relays: DataFrame, scored: DataFrame, hourly: DataFrame, as_of: int, status: str | None = None, tier: str | None = None, **page) -> DataFrame:
    """The page, and beside each row how many relays the filters leave in all; a page behind the end is empty."""
    own = relays
    for name, value in (("status", status), ("tier", tier)):
        own = own if value is None else own.where(F.col(name) == value)
    # One row.
    return listing(relays, scored, hourly, as_of, status, tier, **page).join(F.broadcast(own.agg(F.count("*").alias("total"))))


def catalog_gauges(catalog: DataFrame, nip: str = "77") -> DataFrame:
    """One row: relays in the catalog, those with a URL that have the feature, and monitors."""
    able = (F.col("relay_id_kind") == "url") & tx.delimited_has(F.col("supported_nips"), nip)
    return catalog.agg(F.count_distinct("relay_id").alias("known"), F.count_distinct(F.when(able, F.col("relay_id"))).alias("reconcilable"), F.count_distinct("monitor_pubkey").alias("monitors"))


def throughput(hourly: DataFrame, as_of: int, hours: int = 24) -> DataFrame:
    since = as_of - limits(hours, 24, 168) * HOUR
    own = hourly.where(F.col("hour_start") >= since - since % HOUR)
    return own.groupBy("hour_start").agg(F.sum("events_received").cast("bigint").alias("events_received"), F.sum("events_novel").cast("bigint").alias("events_novel"), F.count_distinct("relay_url").alias("active_relays"))


def gauges(relays: DataFrame, scored: DataFrame, hourly: DataFrame, as_of: int) -> DataFrame:
    sum_of = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    is_ = lambda c, v: F.count_if(F.col(c) == v)
    counts = relays.agg(F.count("*").alias("total_relays"), is_("status", "active").alias("active_relays"), is_("status", "blocked").alias("blocked_relays"), is_("tier", "seed").alias("seed_relays"), is_("tier", "discovered").alias("discovered_relays"))
    hour = hourly.where(F.col("hour_start") >= as_of - HOUR).agg(sum_of("events_novel").alias("events_novel_1h"), sum_of("events_duplicate").alias("events_duplicate_1h"))
    # Single rows.
    return counts.join(F.broadcast(hour)).join(F.broadcast(scored.agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("avg_score"))))


def _numbered(rows: DataFrame, *order) -> DataFrame:
    """rows and n, their number from 1 in an order; dealt by ranges, of which each is numbered from where those before it end."""
    spark, path = rows.sparkSession, shared(rows.sparkSession, "numbered")
    rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).withColumn("part", F.spark_partition_id()).write.parquet(path)
    ranges = spark.read.parquet(path)
    # A row for each range.
    before = ranges.groupBy("part").agg(F.count("*").alias("rows")).select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("before"))
    own = ranges.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    return own.join(F.broadcast(before), "part").withColumn("n", F.col("before") + F.col("nth")).drop("part", "before", "nth")


def swaps(relays: DataFrame, scored: DataFrame, connected: DataFrame, share: float = 0.05, better_by: float = 0.1, candidates: int | None = 100) -> DataFrame:
    """Pairs (disconnect, connect): the n-th worst connected relay that isn't a seed's turn with the n-th best other one, if that is better by enough.

    connected: a frame of urls. At most this share of them, one at least, and
    no more than ``candidates`` (None: the share alone counts).
    """
    n = connected.count()
    most = max(1, -int(-n * share // 1))
    most = most if candidates is None else min(most, candidates)
    named = relays.select("url", "tier", "status").join(scored.select(F.col("relay_url").alias("url"), "score"), "url", "left")
    # Scores are made once, for both lists and their ranges.
    named.write.parquet(path := shared(relays.sparkSession, "scored"))
    named = relays.sparkSession.read.parquet(path)
    is_seed = F.col("tier") == "seed"
    ours = connected.select("url").join(named, "url", "left").select("url", F.when(is_seed, F.lit(float("inf"))).otherwise(F.coalesce("score", F.lit(0.0))).alias("low"))
    others = named.where(~F.col("status").isin("blocked", "active", "failing")).join(connected.select("url"), "url", "left_anti").select(F.col("url").alias("connect"), F.coalesce("score", F.lit(0.0)).alias("high"))
    pairs = _numbered(ours, "low", "url").where(F.col("n") <= most).join(_numbered(others, F.desc("high"), "connect"), "n")
    return pairs.where(F.col("high") > F.col("low") + better_by).select(F.col("url").alias("disconnect"), "connect")


def priority(relays: DataFrame, scored: DataFrame, limit: int) -> DataFrame:
    """Relays to connect to: seeds first, then by score."""
    own = relays.where("status <> 'blocked'").join(scored.select(F.col("relay_url").alias("url"), "score"), "url", "left")
    return own.orderBy(F.when(F.col("tier") == "seed", 0).otherwise(1), F.desc(F.coalesce("score", F.lit(0.0))), "url").limit(limit).select("url", "tier", F.coalesce("score", F.lit(0.0)).alias("score"))


def explore(relays: DataFrame, limit: int, seed: int) -> DataFrame:
    """Relays to try at random, the same for the same seed."""
    return relays.where("status IN ('pending', 'idle')").orderBy(F.xxhash64("url", F.lit(seed)), "url").limit(limit).select("url")


def catalog_targets(catalog: DataFrame, as_of: int, limit: int, least_monitors: int, most_age: int, nip: str = "77") -> DataFrame:
    """Relays that enough recent monitors saw with the feature and none with a payment; the quickest first, those without a time last."""
    own = catalog.where((F.col("relay_id_kind") == "url") & (F.col("observed_at") >= as_of - most_age))
    out = own.groupBy("relay_id").agg(F.count_if(tx.delimited_has(F.col("supported_nips"), nip)).alias("votes"), F.count_if(tx.delimited_has(F.col("requirements"), "payment")).alias("paid"), F.min("rtt_open").alias("rtt"))
    return out.where((F.col("votes") >= least_monitors) & (F.col("paid") == 0)).orderBy(F.asc_nulls_last("rtt"), "relay_id").limit(limit).select("relay_id", "rtt")


def merge_counters(have: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """Counters added up by key: an upsert that adds."""
    both = have.unionByName(more)
    return both.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in have.columns if c not in keys])


def replace_rows(have: DataFrame, more: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The newest row of each key: an upsert that replaces; of equal versions the new row."""
    both = have.withColumn("_new", F.lit(0)).unionByName(more.withColumn("_new", F.lit(1)))
    rest = [c for c in have.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(version, "_new")).alias("x")).select(*keys, "x.*").select(have.columns)


def insert_missing(have: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    """have with the rows of more whose key it lacks; of several of those the first by all columns."""
    rest = [c for c in have.columns if c not in keys]
    once = more.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("x")).select(*keys, "x.*").select(have.columns)
    return have.unionByName(once.join(have.select(*keys), keys, "left_anti"))


def merge_duplicates(relays: DataFrame, hourly: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Relays and statistics under one form of each URL: earliest first seen, latest connected, summed counts; rejected URLs go."""
    named = relays.withColumn("url", tx.relay_url(F.col("url"))).where("url IS NOT NULL")
    best = F.struct(F.when(F.col("tier") == "seed", 0).otherwise(1), "first_seen_at")
    one = named.groupBy("url").agg(F.min("first_seen_at").alias("first_seen_at"), F.max("last_connected_at").alias("last_connected_at"), F.min_by("tier", best).alias("tier"), F.min_by("status", best).alias("status"))
    stats = hourly.withColumn("relay_url", tx.relay_url(F.col("relay_url"))).where("relay_url IS NOT NULL")
    counts = [c for c in hourly.columns if c not in ("relay_url", "hour_start")]
    return one, stats.groupBy("relay_url", "hour_start").agg(*[F.sum(c).cast("bigint").alias(c) for c in counts])


def connection_states(attempts: DataFrame, block_after: int = 10) -> DataFrame:
    """State of each relay after its attempts (relay_url, at, success), in order of time: a success makes it active and clears failures; so many failures in a row block it.

    Failures since the last success are counted by aggregates, so no relay's history is gathered.
    """
    at = F.struct("at", F.coalesce(F.col("success"), F.lit(False)))
    last = attempts.groupBy("relay_url").agg(F.max(F.when(F.col("success"), F.col("at"))).alias("last_connected_at"), F.max(at).alias("newest"))
    since = attempts.join(last.select("relay_url", "last_connected_at"), "relay_url").where("last_connected_at IS NULL OR at > last_connected_at")
    failures = since.groupBy("relay_url").agg(F.count_if(~F.col("success")).alias("f"))
    out = last.join(failures, "relay_url", "left").select("relay_url", "last_connected_at", F.coalesce("f", F.lit(0)).alias("consecutive_failures"))
    state = F.when(F.col("consecutive_failures") >= block_after, "blocked").when(F.col("consecutive_failures") > 0, "failing").otherwise("active")
    reason = F.when(F.col("consecutive_failures") >= block_after, F.concat(F.lit("Blocked after "), F.col("consecutive_failures").cast("string"), F.lit(" consecutive failures")))
    return out.withColumn("status", state).withColumn("blocked_reason", reason)


def rate_audit(connections: DataFrame, seconds: int = 60, most: int = 10, most_per_ip: int = 2) -> DataFrame:
    """Connections (at, ip, relay_url) with the number opened in the window up to each, over all and by address, and whether that breaks a limit.

    Windows over all connections are dealt by stretches of time; each stretch
    also gets the window before it, so no task holds all rows.
    """
    stretch = 60 * seconds
    own = connections.withColumn("_part", F.floor(F.col("at") / stretch)).withColumn("_guest", F.lit(False))
    guests = own.where(F.col("at") % stretch >= stretch - seconds).withColumn("_part", F.col("_part") + 1).withColumn("_guest", F.lit(True))
    both = own.unionByName(guests)
    over = lambda *k: Window.partitionBy("_part", *k).orderBy("at").rangeBetween(-seconds, 0)
    counted = both.withColumn("recent", F.count("*").over(over())).withColumn("recent_of_ip", F.count("*").over(over("ip")))
    return counted.where("NOT _guest").drop("_part", "_guest").withColumn("limited", (F.col("recent") > most) | (F.col("recent_of_ip") > most_per_ip))


def import_list(spark, path: str) -> DataFrame:
    """URLs of a JSON or text list of relays: objects with a url, or lines of JSON with one, or plain lines; rejected URLs go."""
    if path.endswith((".json", ".jsonl", ".ndjson")):
        rows = spark.read.schema("url string, relays array<string>").option("multiLine", path.endswith(".json")).json(path)
        urls = rows.select(F.explode(F.array_compact(F.concat(F.array("url"), F.coalesce("relays", F.array().cast("array<string>"))))).alias("url"))
    else:
        urls = spark.read.text(path).select(F.col("value").alias("url")).where("url NOT LIKE '#%'")
    return urls.select(tx.relay_url(F.col("url")).alias("url")).where("url IS NOT NULL").distinct()


