"""The canonical event, its fixed values, and strict schema checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the data model.
GENESIS = 1_604_707_200  # 2020-11-07, the first day that counts
LARGEST_API_SECOND = 4_294_967_295  # what an API of 32-bit seconds can show
DAY, HOUR, WEEK = 86_400, 3_600, 604_800
PROFILE, NOTE, FOLLOWS, DELETION, REPOST, REACTION, GENERIC_REPOST = 0, 1, 3, 5, 6, 7, 16
ZAP, RELAY_LIST, LONG_FORM, RELAY_DISCOVERY = 9735, 10002, 30023, 30166
THROWAWAY_KINDS = (445, 1059)
VERSION_KEY, VERSION = "nostr.event_archive.version", "1"

TAGS = T.ArrayType(T.ArrayType(T.StringType(), False), False)

#: Rows of the lake. created_at is an unsigned 64-bit number of seconds.
EVENT = T.StructType([
    T.StructField("id", T.BinaryType(), False),
    T.StructField("pubkey", T.BinaryType(), False),
    T.StructField("created_at", T.DecimalType(20, 0), False),
    T.StructField("kind", T.IntegerType(), False),
    T.StructField("tags", TAGS, False),
    T.StructField("content", T.StringType(), False),
    T.StructField("sig", T.BinaryType(), False),
])


def require(df: DataFrame, expected: T.StructType = EVENT) -> DataFrame:
    """df, if it has exactly the expected columns and types in order; else ValueError."""
    have, want = [(f.name, f.dataType.simpleString()) for f in df.schema], [(f.name, f.dataType.simpleString()) for f in expected]
    if have != want:
        raise ValueError(f"schema {have} is not {want}")
    return df


def representable(created_at: Column) -> Column:
    return created_at <= F.lit(LARGEST_API_SECOND)


def warehouse(events: DataFrame) -> DataFrame:
    """The queryable view of lake rows: hexadecimal ids, created_at as BIGINT seconds; rows beyond 32-bit seconds don't belong to it.

    The filter stands on the unsigned column itself, so it reaches the scan.
    """
    shown = events.where(representable(F.col("created_at")))
    low = lambda c: F.lower(F.hex(c)).alias(c)
    return shown.select(low("id"), low("pubkey"), F.col("created_at").cast("bigint").alias("created_at"), "kind", "tags", "content", low("sig"))
