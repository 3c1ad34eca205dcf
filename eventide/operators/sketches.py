"""Distinct counts by sketch: states that merge, and their estimates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRECISION = 12


def states(events: DataFrame, key: Column, item: str = "pubkey") -> DataFrame:
    """A state of distinct items and a count for each key."""
    return events.groupBy(key.alias("key")).agg(F.hll_sketch_agg(item, F.lit(PRECISION)).alias("items"), F.count("*").alias("event_count"))


def merged(state: DataFrame, key: Column | None = None) -> DataFrame:
    """States joined up by a coarser key, or all."""
    grouped = state.groupBy(key.alias("merged_key")) if key is not None else state.groupBy()
    return grouped.agg(F.hll_union_agg("items").alias("items"), F.sum("event_count").cast("bigint").alias("event_count"))


def estimated(state: DataFrame) -> DataFrame:
    return state.withColumn("distinct_items", F.hll_sketch_estimate("items")).drop("items")


def approximate(events: DataFrame, key: Column, item: str = "pubkey", error: float = 0.02) -> DataFrame:
    return events.groupBy(key.alias("key")).agg(F.approx_count_distinct(item, error).alias("distinct_items"))
