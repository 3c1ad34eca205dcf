"""Delivery to a sink that may fail: tried again after growing waits, then queued on disk for a later run.

A batch that the sink doesn't take within the attempts is written to the queue
by its number, and the stream goes on. ``drain`` delivers what is queued, in
order. A batch's number goes along with its rows, and a mark is made once it is
delivered, so a batch that runs again isn't delivered again. Between the sink's
taking a batch and the mark a stop is possible: sinks replace by the number.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from eventide.operators.catalog import canonical_json
from eventide.operators.publish import Store

#: Attempts and the wait after the first, which doubles each time; rows of a delivery.
ATTEMPTS, WAIT, ROWS = 3, 1.0, 10_000


@dataclass
class Delivery:
    """deliver(rows, batch number) is the sink; ``folder`` holds the queue and the marks."""

    deliver: Callable[[DataFrame, int], None]
    folder: str
    attempts: int = ATTEMPTS
    wait: float = WAIT
    sleep: Callable[[float], None] = time.sleep

    def send(self, batch: DataFrame, number: int) -> str:
        """delivered, queued, or again: it was delivered before."""
        store = Store(batch.sparkSession, self.folder)
        if store.exists(f"delivered/{number:012d}.json"):
            return "again"
        # Written first, so that attempts and a later run send the same rows.
        path = f"{store.base}/queue/{number:012d}"
        batch.write.mode("overwrite").parquet(path)
        return self._try(batch.sparkSession, store, number)

    def _try(self, spark: SparkSession, store: Store, number: int) -> str:
        rows, failed = spark.read.parquet(f"{store.base}/queue/{number:012d}"), None
        for attempt in range(self.attempts):
            try:
                self.deliver(rows, number)
                break
            except Exception as e:  # noqa: BLE001 - whatever a sink raises
                failed = e
                if attempt + 1 < self.attempts:
                    self.sleep(self.wait * 2**attempt)
        else:
            store.write(f"failed/{number:012d}.json", canonical_json({"batch": number, "error": f"{type(failed).__name__}: {failed}"[:500]}), replace=True)
            return "queued"
        store.write(f"delivered/{number:012d}.json", canonical_json({"batch": number}), replace=True)
        store.delete(f"failed/{number:012d}.json")
        store.delete(f"queue/{number:012d}")
        return "delivered"

    def queued(self, spark: SparkSession) -> list[int]:
        return sorted(int(n) for n in Store(spark, self.folder).names("queue"))

    def drain(self, spark: SparkSession) -> dict[int, str]:
        """What became of each queued batch, oldest first; one that fails doesn't hold up the others."""
        store = Store(spark, self.folder)
        out = {}
        for number in self.queued(spark):
            if store.exists(f"delivered/{number:012d}.json"):
                store.delete(f"queue/{number:012d}")
            elif store.exists(f"queue/{number:012d}/_SUCCESS"):
                out[number] = self._try(spark, store, number)
        return out

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        """The stream's batches delivered; what is left from before goes first."""
        self.drain(stream.sparkSession)
        return stream.writeStream.foreachBatch(lambda batch, number: self.send(batch, number) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def in_parts(deliver: Callable[[DataFrame, int], None], rows: int = ROWS) -> Callable[[DataFrame, int], None]:
    """A sink that is written by tasks of about so many rows each."""
    return lambda batch, number: deliver(batch.repartition(max(1, -(-batch.count() // rows))), number)
