"""Serving tables: products that queries read instead of the events, built once for each state of their sources.

A product is published under a run that its sources' files (path, size, time)
and the builder's version name. A query follows the product's pointer; where
that names another run, or none, the product is built and published first.
Publication is atomic, so readers see a whole product. Sessions without a
shared folder on a cluster build in the query instead.
"""

from __future__ import annotations

import json
import tempfile
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from eventide.operators.catalog import digest
from eventide.operators.publish import Stale, Store, pointer, publish

#: Changes with what the builders compute.
BUILT = 1
#: Times that a query looks anew after another has published first.
TRIES = 3


def folder(spark: SparkSession) -> str | None:
    """Where products stand: beside the session's checkpoints; in local sessions without these a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return f"{named.rstrip('/')}/serving"
    if not spark.sparkContext.master.startswith("local"):
        return None
    context = spark.sparkContext
    if not hasattr(context, "_eventide_serving"):
        context._eventide_serving = "file://" + tempfile.mkdtemp(prefix="eventide-serving-")
    return context._eventide_serving


def state_of(spark: SparkSession, paths: list[str]) -> list[list]:
    """Path, size and time of every file of the sources."""
    jvm, conf, out = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), []
    for path in paths:
        at = jvm.org.apache.hadoop.fs.Path(path)
        fs = at.getFileSystem(conf)
        files = fs.listFiles(at, True)
        while files.hasNext():
            s = files.next()
            out.append([s.getPath().toString(), s.getLen(), s.getModificationTime()])
    return sorted(out)


def product(spark: SparkSession, name: str, paths: list[str], build: Callable[[], DataFrame], files: int | None = None) -> DataFrame:
    """The product, read from its published run; ``files``: for small ones, so many."""
    base = folder(spark)
    if base is None:
        return build()
    base = f"{base}/{name}-{digest([name, paths])[:16]}"
    for _ in range(TRIES):
        run = digest([name, BUILT, state_of(spark, paths)])[:32]
        now = pointer(spark, base)
        if now is None or now["run_id"] != run:
            made = build()
            try:
                publish(spark, base, run, {name: made.coalesce(files) if files else made}, {"schema": made.schema.jsonValue()}, now["run_id"] if now else None, again=True)
            except Stale:
                continue  # another query has published meanwhile, maybe the same
            now = pointer(spark, base)
        if now["run_id"] == run:
            schema = T.StructType.fromJson(json.loads(Store(spark, base).read(f"{now['folder']}/evidence.json"))["schema"])
            return spark.read.schema(schema).parquet(f"{base}/{now['folder']}/{name}")
    return build()  # sources that change all the time


@dataclass(frozen=True)
class Answer:
    """Rows of a finished query, a tag that changes with them, and when they were made."""

    rows: tuple
    etag: str
    made: float


class Answers:
    """Finished answers by key, kept for so many seconds each; of several that ask at once for one that is missing, one computes it and the others wait.

    For answers as small as a page: a query of over ``MOST_ROWS`` rows is refused
    rather than gathered. A query that fails is not kept, and the next one tries.
    """

    MOST_ROWS = 10_000

    def __init__(self, clock: Callable[[], float] = time.monotonic):
        self.clock, self.lock = clock, threading.Lock()
        self.held: dict[str, tuple[Answer, float]] = {}
        self.busy: dict[str, threading.Lock] = {}

    def _fresh(self, key: str) -> Answer | None:
        found = self.held.get(key)
        return found[0] if found and self.clock() < found[0].made + found[1] else None

    def get(self, key: str, seconds: float, query: Callable[[], DataFrame]) -> Answer:
        with self.lock:
            if (found := self._fresh(key)) is not None:
                return found
            own = self.busy.setdefault(key, threading.Lock())
        with own:
            # Whoever was first may have made it while this one waited.
            with self.lock:
                if (found := self._fresh(key)) is not None:
                    return found
            rows = tuple(query().limit(self.MOST_ROWS + 1).collect())
            if len(rows) > self.MOST_ROWS:
                raise ValueError(f"{key} has over {self.MOST_ROWS} rows")
            made = Answer(rows, digest([[str(v) for v in r] for r in rows])[:32], self.clock())
            with self.lock:
                self.held[key] = made, seconds
                self.busy.pop(key, None)
                # What is over goes, so keys that nobody asks for again don't stay.
                for k in [k for k, (a, s) in self.held.items() if self.clock() >= a.made + s]:
                    del self.held[k]
            return made

    def if_changed(self, key: str, seconds: float, query: Callable[[], DataFrame], etag: str | None) -> Answer | None:
        """The answer, or None if the one who asks has it already."""
        found = self.get(key, seconds, query)
        return None if found.etag == etag else found

    def forget(self, key: str) -> None:
        with self.lock:
            self.held.pop(key, None)
