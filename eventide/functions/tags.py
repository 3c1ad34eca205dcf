"""Tags: arrays of arrays of strings. Missing places are '' and nothing raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEX64 = "^[0-9a-fA-F]{64}$"


def at(tag: Column, i: int) -> Column:
    """Place i (from 0) of a tag, '' if missing."""
    return F.coalesce(F.get(tag, F.lit(i)), F.lit(""))


def named(tags: Column, name: str) -> Column:
    return F.filter(tags, lambda t: F.get(t, F.lit(0)) == name)


def first(tags: Column, name: str, place: int = 1) -> Column:
    """A place of the first tag of that name, '' if there is none."""
    return at(F.get(named(tags, name), F.lit(0)), place)


def has(tags: Column, name: str, size: int = 1) -> Column:
    return F.exists(tags, lambda t: (F.size(t) >= size) & (F.get(t, F.lit(0)) == name))


def values(tags: Column, name: str) -> Column:
    """The second places of all tags of that name that have one."""
    return F.transform(F.filter(tags, lambda t: (F.size(t) >= 2) & (F.get(t, F.lit(0)) == name)), lambda t: F.get(t, F.lit(1)))


def has_empty(tags: Column) -> Column:
    return F.exists(tags, lambda t: F.size(t) == 0)


def derived(events: DataFrame) -> DataFrame:
    """events with the columns that are made as rows come in: d_tag, title, thumbnail, video_url."""
    return events.withColumns({"d_tag": first(F.col("tags"), "d"), "title": first(F.col("tags"), "title"), "thumbnail": first(F.col("tags"), "thumb"), "video_url": first(F.col("tags"), "url")})


def flat(events: DataFrame) -> DataFrame:
    """A row for each tag; events without tags have none."""
    tag = F.col("tag")
    return events.select("id", "pubkey", "kind", "created_at", F.explode("tags").alias("tag")).select(
        F.col("id").alias("event_id"), "pubkey", "kind", at(tag, 0).alias("tag_name"), at(tag, 1).alias("tag_value_primary"), *[at(tag, i).alias(f"tag_value_{i}") for i in range(2, 6)],
        tag.alias("tag_full"), (F.size(tag) - 1).alias("tag_value_count"), "created_at",
    )


def exploded(events: DataFrame, name: str, *kinds: int) -> DataFrame:
    """id, pubkey, created_at and target: the second place of each such tag of events of these kinds."""
    own = events.where(F.col("kind").isin(*kinds)) if kinds else events
    return own.select("id", "pubkey", "created_at", F.explode(values(F.col("tags"), name)).alias("target"))


def references(events: DataFrame) -> DataFrame:
    """id and referenced id (64 hexadecimal digits) of e and q tags."""
    ref = F.filter(F.col("tags"), lambda t: F.get(t, F.lit(0)).isin("e", "q") & F.coalesce(F.get(t, F.lit(1)).rlike(HEX64), F.lit(False)))
    return events.select("id", F.explode(F.transform(ref, lambda t: F.lower(F.get(t, F.lit(1))))).alias("reference"))


def parent(events: DataFrame) -> DataFrame:
    """Notes with the event they reply to: the marked reply, else the marked root, else the last unmarked e tag; and its author, the first p tag."""
    e = named(F.col("tags"), "e")
    marked = lambda m: F.get(F.transform(F.filter(e, lambda t: at(t, 3) == m), lambda t: at(t, 1)), F.lit(0))
    plain = F.transform(F.filter(e, lambda t: at(t, 3) == ""), lambda t: at(t, 1))
    found = F.coalesce(marked("reply"), marked("root"), F.get(plain, F.size(plain) - 1))
    own = events.where("kind = 1").select("id", F.when(found.rlike(HEX64), F.lower(found)).alias("parent"), F.nullif(first(F.col("tags"), "p"), F.lit("")).alias("parent_pubkey"))
    return own.where("parent IS NOT NULL")


def repost_target(events: DataFrame) -> DataFrame:
    """Reposts with the first event they name."""
    return events.where(F.col("kind").isin(6, 16)).select("id", first(F.col("tags"), "e").alias("target")).where("target <> ''")


def discovery(events: DataFrame) -> DataFrame:
    """Relay announcements (kind 30166): one row each, last or repeated values by the tag's rule."""
    tags = F.col("tags")
    last = lambda n: F.get(F.reverse(values(tags, n)), F.lit(0))
    number = lambda n: F.coalesce(F.when(F.col(n) >= 0, F.col(n)))
    rtt = {f"rtt_{w}": last(f"rtt-{w}").try_cast("int") for w in ("open", "read", "write")}
    out = events.where("kind = 30166").select(
        F.lower(F.regexp_replace(F.trim(F.get(values(tags, "d"), F.lit(0))), "/+$", "")).alias("relay_id"), F.col("pubkey").alias("monitor_pubkey"), last("n").alias("network"),
        F.array_sort(F.array_distinct(F.filter(F.transform(values(tags, "N"), lambda x: x.try_cast("int")), lambda x: x.isNotNull()))).alias("supported_nips"),
        F.array_sort(F.array_distinct(values(tags, "R"))).alias("requirements"), *[c.alias(n) for n, c in rtt.items()], last("g").alias("geohash"), F.col("created_at").alias("observed_at"),
    )
    return out.withColumns({n: number(n) for n in rtt}).where("relay_id <> ''")
