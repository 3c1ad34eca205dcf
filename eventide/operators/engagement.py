"""Counters of what refers to an event; scores; lookups of single events and profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions import tags as tg
from eventide.functions import text as tx
from eventide.functions import time as tm
from eventide.schema import DAY, DELETION, GENERIC_REPOST, NOTE, PROFILE, REACTION, REPOST


def counts(events: DataFrame, *kinds: int) -> DataFrame:
    return tg.exploded(events, "e", *kinds).groupBy("target").agg(F.count("*").alias("n"))


def reactions(events: DataFrame) -> DataFrame:
    return counts(events, REACTION).withColumnRenamed("n", "reaction_count")


def comments(events: DataFrame) -> DataFrame:
    return counts(events, NOTE).withColumnRenamed("n", "comment_count")


def reposts(events: DataFrame) -> DataFrame:
    return counts(events, REPOST, GENERIC_REPOST).withColumnRenamed("n", "repost_count")


def deletions(events: DataFrame) -> DataFrame:
    """Deleted ids with the latest deletion. They are an index only; no view applies them."""
    return tg.exploded(events, "e", DELETION).groupBy("target").agg(F.max("created_at").alias("deleted_at"))


def scored(posts: DataFrame, events: DataFrame) -> DataFrame:
    """posts (id, ...) with reactions, comments, reposts and engagement_score.

    The three counters come from one pass over the tags and one join.
    """
    kind = F.col("kind")
    e = events.where(kind.isin(NOTE, REPOST, REACTION, GENERIC_REPOST)).select("kind", F.explode(tg.values(F.col("tags"), "e")).alias("target"))
    c = e.groupBy("target").agg(F.count_if(kind == REACTION).alias("reactions"), F.count_if(kind == NOTE).alias("comments"), F.count_if(kind.isin(REPOST, GENERIC_REPOST)).alias("reposts"))
    out = posts.join(c, posts["id"] == c["target"], "left").drop("target").fillna(0, ["reactions", "comments", "reposts"])
    return out.withColumn("engagement_score", F.col("reactions") + F.col("comments") * 2 + F.col("reposts") * 3)


def trending(scores: DataFrame, as_of: int, days: int = 30) -> DataFrame:
    """Scores of the last days, less by a factor e for each week of age."""
    recent = scores.where(F.col("created_at") > as_of - days * DAY)
    return recent.withColumn("trending_score", F.col("engagement_score") * F.exp(-tm.hours_between("created_at", F.lit(as_of)) / 168.0))


def hashtags(posts: DataFrame, events: DataFrame) -> DataFrame:
    """event_id, hashtag, created_at of posts."""
    t = events.select(F.col("id").alias("event_id"), F.explode(tg.values(F.col("tags"), "t")).alias("hashtag"))
    return t.join(posts.select(F.col("id").alias("event_id"), "created_at"), "event_id")


def popular_hashtags(posts: DataFrame, events: DataFrame) -> DataFrame:
    return hashtags(posts, events).groupBy("hashtag").agg(F.count("*").alias("post_count"), F.count_distinct("event_id").alias("unique_posts"))


def top_creators(scores: DataFrame, limit: int) -> DataFrame:
    out = scores.groupBy("pubkey").agg(F.count("*").alias("posts"), F.sum("engagement_score").cast("bigint").alias("total_score"), F.sum("reactions").cast("bigint").alias("total_reactions"))
    return out.orderBy(F.desc("total_score"), "pubkey").limit(limit)


def latest(events: DataFrame, *keys: str) -> DataFrame:
    """The newest event of each key; of equal times the greatest id."""
    rest = [c for c in events.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct("created_at", "id")).alias("x")
    return events.groupBy(*keys).agg(best).select(*keys, *[F.col(f"x.{c}").alias(c) for c in rest]).select(events.columns)


def profiles(events: DataFrame) -> DataFrame:
    """Each author's newest profile with the number of updates."""
    own = events.where(F.col("kind") == PROFILE)
    best = F.max_by("content", F.struct("created_at", "id"))
    return own.groupBy("pubkey").agg(best.alias("content"), F.max("created_at").alias("last_update"), F.count("*").alias("update_count"))


def display_names(events: DataFrame) -> DataFrame:
    """Names to show; authors without one have no row."""
    return profiles(events).select("pubkey", tx.profile(F.col("content"))["shown"].alias("display_name")).where("display_name <> 'Anonymous'")


def by_ids(events: DataFrame, ids: DataFrame) -> DataFrame:
    """The events of a frame of ids, in one join instead of a loop."""
    return events.join(ids.select("id").distinct(), "id", "left_semi")


def replaceable(events: DataFrame, kind: int, pubkey, d_tag: str) -> DataFrame:
    own = events.where((F.col("kind") == kind) & (F.col("pubkey") == pubkey) & (tg.first(F.col("tags"), "d") == d_tag))
    return own.orderBy(F.desc("created_at"), F.desc("id")).limit(1)


def of_event(events: DataFrame, zaps: DataFrame, target: str) -> DataFrame:
    """Reactions, replies, reposts and zaps of one event, one row."""
    from eventide.operators.zaps import for_target

    kind = F.col("kind")
    near = events.where(F.array_contains(tg.values(F.col("tags"), "e"), target))
    c = near.agg(F.count_if(kind == REACTION).alias("reactions"), F.count_if(kind == NOTE).alias("replies"), F.count_if(kind.isin(REPOST, GENERIC_REPOST)).alias("reposts"))
    # One row beside one row.
    return c.join(F.broadcast(for_target(zaps, events, target)))


def resolve(events: DataFrame, identifier: str) -> DataFrame:
    """What an identifier names: 64 hexadecimal digits an event, else an author's newest profile; encoded forms by their kind."""
    from eventide.functions import bech32

    found = bech32.parse(identifier)
    if found["type"] == "address":
        return replaceable(events, found["kind"], found["pubkey"], found["d"])
    event = events.where(F.col("id") == found["hex"])
    author = events.where((F.col("kind") == PROFILE) & (F.col("pubkey") == found["hex"])).orderBy(F.desc("created_at"), F.desc("id")).limit(1)
    if found["type"] != "hex":
        return event if found["type"] == "event" else author
    both = event.withColumn("_rank", F.lit(0)).unionByName(author.withColumn("_rank", F.lit(1)))
    return both.orderBy("_rank").limit(1).drop("_rank")
