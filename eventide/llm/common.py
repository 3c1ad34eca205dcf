"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import math
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of (compressed) input that one dealt partition should get at most.
PARTITION_BYTES = 32 << 20
#: Sizes from here on are Spark's default for sources without statistics, or products of it.
UNKNOWN = 1 << 60


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one only where the session names none (local tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="eventide-")
        spark.sparkContext.setCheckpointDir(named)
    return named


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


class Known(dict):
    """What a worker has learned of strings, as bytes, within a bound of about ``most`` bytes.

    A string stays from the second time on that it is new, as most are never
    met again. Beyond the bound only what is in use stays.
    """

    #: Bytes of an entry beside its characters and value, and marks of strings that were met once.
    ENTRY, MARKS = 220, 1 << 22

    def __init__(self, most: int = 48 << 20):
        super().__init__()
        self.most, self.held, self.met, self.marked = most, 0, bytearray(self.MARKS), 0

    def enter(self, used: set[str]) -> list[str]:
        """Those of the strings that aren't known yet; all others stay."""
        if self.held > self.most:
            kept = {p: self[p] for p in used & self.keys()}
            self.clear()
            self.update(kept)
            self.held = sum(map(len, self)) + self.ENTRY * len(self)
        return list(used.difference(self))

    def leave(self, new: list[str]) -> None:
        """Drop those of the new strings that were met once."""
        for p in new:
            at = hash(p) % self.MARKS
            if self.met[at]:
                self.held += len(p) + self.ENTRY
            else:
                self.met[at] = 1
                self.marked += 1
                del self[p]
        if self.marked > self.MARKS // 2:
            self.met, self.marked = bytearray(self.MARKS), 0


def partitions(df: DataFrame) -> int:
    """Partitions to deal a frame into: the session's shuffle partitions, more where the input is larger.

    A frame whose size Spark doesn't know (it then takes it as the largest
    there is) counts with the partitions it has.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    needed = df.rdd.getNumPartitions() if size >= UNKNOWN else math.ceil(size / PARTITION_BYTES)
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), needed)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def row_key(text: str = "text") -> Column:
    """Tells rows apart that share a doc_id; rows with the same doc_id and text share a key."""
    return F.xxhash64("doc_id", text_or_empty(text))


def spare(df: DataFrame, *names: str) -> list[str]:
    """Names for columns of an operator's own, none of which the frame has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        own = f"_{name}"
        while own in taken:
            own = f"_{own}"
        taken.add(own)
        out.append(own)
    return out


#: Keys that are salted, and parts that each of them is dealt into. All others have less than a HOT-th of all rows.
HOT, SALTS = 1000, 64


def salted_join(rows: DataFrame, by: DataFrame, key: str, how: str, spread: list[str], counts: DataFrame | None = None) -> DataFrame:
    """rows joined with ``by``, which has a row for each key, where some keys have very many rows.

    ``counts`` (or ``by``, whose ``n`` is dropped) has key and ``n``, the key's
    number of rows. The HOT most frequent keys are known to all tasks; their
    rows are dealt into parts by the ``spread`` columns, and their row of
    ``by`` is given to each part.
    """
    counted = by if counts is None else counts
    flag, salt = spare(rows, "hot", "salt")
    # HOT rows, whatever the table.
    hot = counted.orderBy(F.desc("n"), key).limit(HOT).select(key, F.lit(True).alias(flag))
    part = F.when(F.col(flag), F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int")).otherwise(0)
    parts = F.when(F.col(flag), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    dealt = lambda df, made: df.join(F.broadcast(hot), key, "left").withColumn(salt, made).drop(flag)
    return dealt(rows, part).join(dealt(by.drop("n") if counts is None else by, F.explode(parts)), [key, salt], how).drop(salt)


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once; a plain reference inside a lambda is evaluated for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def crc_mod(n: int) -> Column:
    """crc32 of the doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def mix64(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that every bit depends on all others."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(32)
    return h


def rolling(h: np.ndarray, k: int, base: int) -> np.ndarray:
    """Polynomial hash, modulo 2**64, of every k consecutive values; by doubling, so in log2(k) passes."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out, width, done = None, 1, 0
    span, power = h, base
    while True:
        if k & width:
            piece = span
            if out is None:
                out, done = piece[: len(h)], width
            else:
                # The piece stands behind what is done so far.
                m = len(piece) - done
                out = out[:m] * np.uint64(pow(base, width, 1 << 64)) + piece[done:]
                done += width
        width *= 2
        if width > k:
            break
        half = width // 2
        span = span[:-half] * np.uint64(power) + span[half:] if len(span) > half else span[:0]
        power = power * power % (1 << 64)
    return mix64(out[:n].copy())

