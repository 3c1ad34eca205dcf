"""Exact rollups of events, and statistics by period and kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions import tags as tg
from eventide.functions import time as tm
from eventide.functions.text import byte_length
from eventide.schema import DAY, GENESIS, HOUR, LARGEST_API_SECOND, LONG_FORM, WEEK


def distinct_events(events: DataFrame) -> DataFrame:
    """One row for each (id, created_at, kind): three narrow columns, whatever the table's width."""
    return events.select("id", "created_at", "kind").distinct()


def conflicts(events: DataFrame) -> DataFrame:
    """Ids that stand with different committed fields."""
    return distinct_events(events).groupBy("id").agg(F.count("*").alias("n_versions")).where("n_versions > 1")


def overview(canonical: DataFrame, as_of: int) -> DataFrame:
    """One row over distinct events."""
    at = F.col("created_at")
    shown = at <= LARGEST_API_SECOND
    recent = shown & (at >= tm.window_start(as_of, WEEK))
    events_7d = F.count_if(recent)
    return canonical.agg(
        F.count("*").alias("total_events"), F.count_if(shown).alias("representable_events"),
        F.greatest(F.coalesce(F.min(F.when(shown, at)), F.lit(0)), F.lit(GENESIS)).cast("bigint").alias("earliest_event"),
        F.coalesce(F.max(F.when(shown & (at <= as_of), at)), F.lit(0)).cast("bigint").alias("latest_event"),
        events_7d.alias("events_7d"), (events_7d / 168.0).alias("events_per_hour_7d"),
        F.count_distinct(F.when(shown & (at >= tm.window_start(as_of, 30 * DAY)), F.col("kind"))).alias("kinds_30d"),
    )


def daily(canonical: DataFrame) -> DataFrame:
    return canonical.where(F.col("created_at") <= LARGEST_API_SECOND).groupBy(tm.day(F.col("created_at").cast("bigint")).alias("day")).agg(F.count("*").alias("event_count"))


def daily_kind(canonical: DataFrame) -> DataFrame:
    return canonical.where(F.col("created_at") <= LARGEST_API_SECOND).groupBy(tm.day(F.col("created_at").cast("bigint")).alias("day"), "kind").agg(F.count("*").alias("event_count"))


def kind_all_time(canonical: DataFrame) -> DataFrame:
    return canonical.groupBy("kind").agg(F.count("*").alias("event_count"))


def additive(*rollups: DataFrame) -> DataFrame:
    """Rollups of disjoint events added up: all columns but event_count are the key."""
    both = rollups[0]
    for r in rollups[1:]:
        both = both.unionByName(r)
    return both.groupBy(*[c for c in both.columns if c != "event_count"]).agg(F.sum("event_count").cast("bigint").alias("event_count"))


def kinds(events: DataFrame) -> DataFrame:
    """Exact statistics of each kind."""
    return events.groupBy("kind").agg(F.count("*").alias("event_count"), F.count_distinct("pubkey").alias("unique_pubkeys"), F.min("created_at").alias("first_seen"), F.max("created_at").alias("last_seen"))


def kind_detail(events: DataFrame, kind: int, as_of: int) -> DataFrame:
    """One row, or none for a kind without events."""
    at = F.col("created_at")
    since = lambda s: F.count_if(at >= as_of - s)
    return (
        events.where(F.col("kind") == kind)
        .agg(
            F.lit(kind).alias("kind"), F.count("*").alias("event_count"), F.count_distinct("pubkey").alias("unique_pubkeys"), F.min("created_at").alias("first_seen"), F.max("created_at").alias("last_seen"),
            F.avg(byte_length(F.col("content"))).alias("avg_content_length"), since(DAY).alias("events_24h"), since(WEEK).alias("events_7d"), since(30 * DAY).alias("events_30d"),
        )
        .where("event_count > 0")
    )


def by_period(events: DataFrame, grain: str, limit: int) -> DataFrame:
    """The latest periods: period, count, unique_pubkeys."""
    out = events.groupBy(tm.bucket("created_at", grain).alias("p")).agg(F.count("*").alias("count"), F.count_distinct("pubkey").alias("unique_pubkeys"))
    return out.orderBy(F.desc("p")).limit(limit).select(tm.shown(F.col("p")).alias("period"), "count", "unique_pubkeys")


def kind_activity(events: DataFrame, grain: str) -> DataFrame:
    """Of all kinds: kind, p (start of the period), count, unique_pubkeys; files are sorted by kind, so a reader of one kind skips the rest."""
    out = events.groupBy("kind", tm.bucket("created_at", grain).alias("p")).agg(F.count("*").alias("count"), F.count_distinct("pubkey").alias("unique_pubkeys"))
    return out.sortWithinPartitions("kind", "p")


def within(events: DataFrame, as_of: int | None = None, days: int | None = None, since: int | None = None, until: int | None = None, kind: int | None = None) -> DataFrame:
    """Half-open window: since counts, until doesn't, days replaces both; as_of, where given, cuts off the future."""
    at, conditions = F.col("created_at"), []
    if as_of is not None:
        conditions.append(at <= as_of)
    if days is not None:
        if as_of is None:
            raise ValueError("days needs as_of")
        conditions.append(at >= as_of - days * DAY)
    else:
        conditions += [at >= since] if since is not None else []
        conditions += [at < until] if until is not None else []
    conditions += [F.col("kind") == kind] if kind is not None else []
    for c in conditions:
        events = events.where(c)
    return events


def throughput(events: DataFrame, as_of: int, kind: int | None = None, cap_future: bool = False) -> DataFrame:
    """Events of seven days, and by hour."""
    own = within(events, kind=kind, since=as_of - WEEK)
    own = own.where(F.col("created_at") <= as_of) if cap_future else own
    return own.agg(F.count("*").alias("events_7d"), (F.count("*") / 168.0).alias("events_per_hour"))


def hourly_activity(events: DataFrame, as_of: int, days: int = 7, kind: int | None = None, cap_future: bool = False) -> DataFrame:
    own = within(events, kind=kind, since=as_of - days * DAY)
    own = own.where(F.col("created_at") <= as_of) if cap_future else own
    return own.groupBy(tm.hour_of_day("created_at").alias("hour")).agg(F.count("*").alias("event_count"), F.count_distinct("pubkey").alias("unique_pubkeys"), (F.count("*") / float(days)).alias("avg_per_day"))


def publishers(events: DataFrame, as_of: int, days: int, limit: int, kind: int | None = None) -> DataFrame:
    own = within(events, kind=kind, since=as_of - days * DAY)
    out = own.groupBy("pubkey").agg(F.count("*").alias("event_count"), F.count_distinct("kind").alias("kinds_count"), F.min("created_at").alias("first_event"), F.max("created_at").alias("last_event"))
    return out.orderBy(F.desc("event_count"), "pubkey").limit(limit)


def engagement(events: DataFrame, as_of: int, days: int = 30) -> DataFrame:
    """Replies and reactions for each original note; the base is 1 at least."""
    kind, is_reply = F.col("kind"), tg.has(F.col("tags"), "e")
    counts = within(events, since=as_of - days * DAY).where(kind.isin(1, 7)).agg(F.count_if(kind == 1).alias("notes"), F.count_if((kind == 1) & is_reply).alias("replies"), F.count_if(kind == 7).alias("reactions"))
    originals = F.col("notes") - F.col("replies")
    base = F.greatest(originals, F.lit(1))
    return counts.select(F.lit(days).alias("period_days"), originals.alias("original_notes"), "replies", "reactions", (F.col("replies") / base).alias("replies_per_note"), (F.col("reactions") / base).alias("reactions_per_note"))


def long_form(events: DataFrame, kind: int = LONG_FORM) -> DataFrame:
    n = byte_length(F.col("content"))
    return events.where(F.col("kind") == kind).agg(
        F.count("*").alias("articles"), F.count_distinct("pubkey").alias("authors"), F.coalesce(F.avg(n), F.lit(0.0)).alias("avg_length"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("total_length"), F.floor(F.coalesce(F.sum(n), F.lit(0)) / 5).cast("bigint").alias("estimated_words")
    )


def event_stats(events: DataFrame) -> DataFrame:
    """By day and kind: events, authors, mean bytes of content."""
    return events.groupBy(tm.day("created_at").alias("day"), "kind").agg(F.count("*").alias("event_count"), F.count_distinct("pubkey").alias("unique_authors"), F.avg(byte_length(F.col("content"))).alias("avg_content_length"))


def tag_stats(events: DataFrame) -> DataFrame:
    flat = tg.flat(events)
    return flat.groupBy("tag_name").agg(F.count("*").alias("tag_count"), F.count_distinct("event_id").alias("unique_events"), F.count_distinct("tag_value_primary").alias("unique_values"))


def activity_by_kind(events: DataFrame, as_of: int, hours: int = 24) -> DataFrame:
    return within(events, since=as_of - hours * HOUR).groupBy("kind").agg(F.count("*").alias("event_count"), F.count_distinct("pubkey").alias("unique_authors"))


def limits(value: int | None, default: int, most: int) -> int:
    """A row limit: the default where none is given, no more than most; below 1 is refused."""
    if value is not None and value < 1:
        raise ValueError("limit must be 1 or more")
    return min(value if value is not None else default, most)


def choice(value: str, allowed: dict[str, Column | str]) -> Column | str:
    if value not in allowed:
        raise ValueError(f"must be one of {sorted(allowed)}, not {value!r}")
    return allowed[value]
