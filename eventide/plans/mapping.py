"""The supplied tables as event archives, so that every operator runs on them.

``events`` maps onto an archive whose kind is the number in ``props``;
``social`` maps event types onto the kinds of notes, reactions and so on and
builds tags. Time windows that are given are put on the raw column, where the
scan can use them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.functions import time as tm

AS_OF = tm.seconds_of("2024-01-31")
AS_OF_DAY = "2024-01-31"

#: The same mapping in SQL.
EV = """ev AS (
  SELECT event_id AS id, user_id AS pubkey, CAST(floor(epoch(ts)) AS BIGINT) AS created_at,
         CAST(json_extract_string(props, '$.k') AS INT) AS kind, event_type, value, props AS content,
         CAST(ts AS DATE) AS day
  FROM events)"""
SO = """so AS (
  SELECT event_id AS id, user_id AS pubkey, CAST(floor(epoch(ts)) AS BIGINT) AS created_at,
         CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 7 WHEN 'purchase' THEN 9735 WHEN 'signup' THEN 0 ELSE 6 END AS kind,
         CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 211 AS VARCHAR) END AS e, event_type AS t, CAST(user_id % 50 AS VARCHAR) AS p,
         CASE WHEN event_type = 'purchase' THEN concat('lnbc', CAST(CAST(floor(value * 7) AS BIGINT) AS VARCHAR), ['m', 'u', 'n', 'p', ''][event_id % 5 + 1], '1x') END AS bolt11,
         props AS content, CAST(ts AS DATE) AS day
  FROM events),
so_tags AS (
  SELECT id, pubkey, kind, created_at, 'e' AS name, e AS v FROM so WHERE e IS NOT NULL
  UNION ALL SELECT id, pubkey, kind, created_at, 't', t FROM so
  UNION ALL SELECT id, pubkey, kind, created_at, 'p', p FROM so
  UNION ALL SELECT id, pubkey, kind, created_at, 'bolt11', bolt11 FROM so WHERE bolt11 IS NOT NULL)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _raw(spark: SparkSession, sf_dir: str, since: int | None, until: int | None) -> DataFrame:
    raw = table(spark, sf_dir, "events")
    moment = lambda s: F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + INTERVAL '{s}' SECOND")
    raw = raw if since is None else raw.where(F.col("ts") >= moment(since))
    return raw if until is None else raw.where(F.col("ts") < moment(until))


_SECONDS = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"


def events(spark: SparkSession, sf_dir: str, since: int | None = None, until: int | None = None) -> DataFrame:
    return _raw(spark, sf_dir, since, until).select(
        F.col("event_id").alias("id"), F.col("user_id").alias("pubkey"), F.expr(_SECONDS).alias("created_at"), F.get_json_object("props", "$.k").cast("int").alias("kind"), "event_type", "value", F.col("props").alias("content")
    )


def social(spark: SparkSession, sf_dir: str, since: int | None = None, until: int | None = None, types: tuple[str, ...] = ()) -> DataFrame:
    """``types``: of these event types only, on the raw column."""
    t, i = F.col("event_type"), F.col("event_id")
    kind = F.when(t == "view", 1).when(t == "click", 7).when(t == "purchase", 9735).when(t == "signup", 0).otherwise(6)
    unit = F.get(F.array(*[F.lit(u) for u in ("m", "u", "n", "p", "")]), (i % 5).cast("int"))
    invoice = F.concat(F.lit("lnbc"), F.floor(F.col("value") * 7).cast("bigint").cast("string"), unit, F.lit("1x"))
    tags = F.array_compact(F.array(
        F.when(i % 3 == 0, F.array(F.lit("e"), (i % 211).cast("string"))), F.array(F.lit("t"), t), F.array(F.lit("p"), (F.col("user_id") % 50).cast("string")),
        F.when(t == "purchase", F.array(F.lit("bolt11"), invoice)),
    ))
    raw = _raw(spark, sf_dir, since, until)
    raw = raw.where(t.isin(*types)) if types else raw
    return raw.select(i.alias("id"), F.col("user_id").alias("pubkey"), F.expr(_SECONDS).alias("created_at"), kind.alias("kind"), tags.alias("tags"), F.col("props").alias("content"))
