"""Streaming ingest: lines of JSON events in, deduplicated lake rows and hourly counts out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventide.operators import rollups
from eventide.operators.publish import Store, sized_parts
from eventide.operators.validate import one_per_id
from eventide.schema import DAY
from eventide.sources.files import parse_lines


def lines(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """New files of a folder as they come, so many at a time."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(folder)


def events(stream: DataFrame, since: int | None = None, until_future: int | None = None) -> DataFrame:
    """Valid events of a stream of lines, from since on."""
    own = parse_lines(stream).events
    own = own if since is None else own.where(F.col("created_at") >= since)
    return own if until_future is None else own.where(F.col("created_at") <= until_future)


def deduplicated(stream: DataFrame) -> DataFrame:
    """Each id once, however late; its state grows with the ids."""
    return stream.dropDuplicates(["id"])


def deduplicated_within(stream: DataFrame, delay: str) -> DataFrame:
    """Each id once within the delay: bounded state, and a repeat behind it comes through."""
    timed = stream.withColumn("_ts", F.timestamp_seconds("created_at")).withWatermark("_ts", delay)
    return timed.dropDuplicatesWithinWatermark(["id"]).drop("_ts")


def hourly(stream: DataFrame, key: str = "pubkey") -> DataFrame:
    """Counts by hour and key; no watermark, so late events still move old hours."""
    return stream.groupBy(F.window(F.timestamp_seconds("created_at"), "1 hour").alias("w"), key).agg(F.count("*").alias("events")).select(F.unix_timestamp("w.start").alias("hour_start"), key, "events")


def segments(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Each batch one segment folder, named by its number; a batch that runs again replaces its own, so nothing counts twice."""

    def seal(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/segment={number}")

    return stream.writeStream.foreachBatch(seal).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Days of a batch up to which only these days' ids are looked at.
DAYS = 1000


def archive(stream: DataFrame, out: str, checkpoint: str, most_bytes: int = 256 << 20) -> StreamingQuery:
    """Sealed segments of new events: each id once, however late it comes again, in files cut by size.

    A batch first claims its new ids (pending), then seals its segments, then
    marks the ids as archived. Marks lie on disk by day: an id has one time, so
    a batch looks at its own days only, and no state grows in the stream. A
    batch that runs again finds the marks of earlier batches only and writes its
    own files anew, so nothing is sealed twice and nothing is lost.
    """

    def seal(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        store = Store(spark, out)
        day = F.floor(F.col("created_at") / DAY).cast("long").alias("day")
        own = one_per_id(batch)
        if store.exists("archived"):
            seen = spark.read.schema("id string, batch long, day long").parquet(f"{out}/archived").where(F.col("batch") < number)
            days = [r["day"] for r in own.select(day).distinct().limit(DAYS + 1).collect()]
            seen = seen.where(F.col("day").isin(days)) if len(days) <= DAYS else seen
            own = own.join(seen.select("id"), "id", "left_anti").select(batch.columns)
        own.write.mode("overwrite").parquet(f"{out}/pending/batch={number}")
        claimed = spark.read.schema(batch.schema).parquet(f"{out}/pending/batch={number}")
        sized_parts(claimed, most_bytes).sortWithinPartitions("part", "created_at", "id").write.mode("overwrite").partitionBy("part").parquet(f"{out}/segments/batch={number}")
        claimed.select("id", day).write.mode("overwrite").partitionBy("day").parquet(f"{out}/archived/batch={number}")
        store.delete(f"pending/batch={number}")

    return stream.writeStream.foreachBatch(seal).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pending(spark: SparkSession, out: str) -> list[int]:
    """Batches that were claimed but not archived: the stream's next run does them again."""
    store = Store(spark, out)
    return sorted(int(name.partition("=")[2]) for name in store.names("pending"))


def products(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Daily counts by kind of each batch, kept apart by batch number; reading adds them up, so late events count on their own day."""

    def add(batch: DataFrame, number: int) -> None:
        rollups.daily_kind(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_products(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).groupBy("day", "kind").agg(F.sum("event_count").cast("bigint").alias("event_count"))


def shadow(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """A second, independent sink: its failure doesn't touch the others."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def position(events_: DataFrame, as_of: int, last: int = 0) -> int:
    """Where to go on: the newest time up to as_of, never before the last position."""
    newest = events_.where(F.col("created_at") <= as_of).agg(F.max("created_at")).first()[0]
    return max(last, newest or 0)

