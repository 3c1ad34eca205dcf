"""Sinks: canonical lake files, rejects, versioned runs with an atomic pointer, work units."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from py4j.protocol import Py4JJavaError
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators.catalog import canonical_json, digest, moved
from eventide.operators.validate import one_per_id
from eventide.schema import VERSION, VERSION_KEY

# Stable cost of a row's fixed fields, and of each list, tag and text, in bytes.
FIXED_BYTES, EACH_BYTES = 32 + 32 + 8 + 2 + 64, 8


class Store:
    """Small files on any of Hadoop's file systems."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}" if name else self.base)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def names(self, name: str) -> list[str]:
        """What a folder holds; a folder that isn't there holds nothing."""
        return [s.getPath().getName() for s in self.fs.listStatus(self._path(name))] if self.exists(name) else []

    def read(self, name: str) -> bytes:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, name: str, data: bytes, replace: bool = False) -> None:
        """Whole or not at all: written beside, then renamed; without replace an existing file of other content is refused."""
        if not replace and self.exists(name):
            if self.read(name) != data:
                raise FileExistsError(f"{name} is there with other content")
            return
        beside = f"{name}.{digest([name, data.hex()])[:12]}.tmp"
        stream = self.fs.create(self._path(beside), True)
        try:
            stream.write(data)
        finally:
            stream.close()
        if self.read(beside) != data:
            raise OSError(f"{beside} doesn't read back")
        options = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self.conf).rename(self._path(beside), self._path(name), options)

    def create(self, name: str, data: bytes) -> bool:
        """Make a file that isn't there yet, whole; False if another writer was first, whatever the moment.

        The file is written beside and then given its name by a step that the
        file system does at once and for one writer only: a link on a local
        disk, a rename that doesn't replace on a cluster's file system.
        Object stores have no such step and are refused.
        """
        scheme = self.fs.getUri().getScheme()
        if scheme not in ("file", "hdfs", "viewfs"):
            raise NotImplementedError(f"{scheme}: no step that makes a file once only")
        beside = f"{name}.{uuid.uuid4().hex}.tmp"
        stream = self.fs.create(self._path(beside), False)
        try:
            stream.write(data)
        finally:
            stream.close()
        try:
            if scheme == "file":
                local = lambda n: self.jvm.java.nio.file.Paths.get(self._path(n).toUri().getPath(), self.spark.sparkContext._gateway.new_array(self.jvm.java.lang.String, 0))
                self.jvm.java.nio.file.Files.createLink(local(name), local(beside))
            else:
                none = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
                self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._path("").toUri(), self.conf).rename(self._path(beside), self._path(name), none)
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False
        finally:
            self.delete(beside)
        return True

    def modified(self, name: str) -> float:
        return self.fs.getFileStatus(self._path(name)).getModificationTime() / 1000

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


def row_bytes() -> Column:
    """A stable estimate of a row's size before compression."""
    tags = F.aggregate("tags", F.lit(0), lambda n, t: n + EACH_BYTES + F.aggregate(t, F.lit(0), lambda m, x: m + EACH_BYTES + F.octet_length(x)))
    return (F.lit(FIXED_BYTES + 2 * EACH_BYTES) + F.octet_length("content") + tags).cast("bigint")


def cuts(sizes: Iterable[int], most: int) -> Iterator[int]:
    """The part of each row: a part goes on while its rows' sizes stay within the limit; a row over it is a part of its own."""
    part, held, empty = 0, 0, True
    for n in sizes:
        if not empty and held + n > most:
            part, held = part + 1, 0
        held, empty = held + n, False
        yield part


def sized_parts(rows: DataFrame, most_bytes: int, ranges: int | None = None) -> DataFrame:
    """rows with part: dealt by ranges of (created_at, id), and cut in that order within each so that parts keep to the size.

    A range takes what a work unit would: it is cut from its first row on, one
    row after the other as they stream through its task, so none is held.
    Parts are numbered through, range by range.
    """
    if most_bytes < 1:
        raise ValueError("most_bytes must be 1 or more")
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = next(c for c in (f"{'_' * i}size" for i in range(1, len(rows.columns) + 2)) if c not in rows.columns)
    ordered = rows.withColumn(size, row_bytes()).repartitionByRange(n, "created_at", "id").sortWithinPartitions("created_at", "id")

    def cut(batches):
        first = TaskContext.get().partitionId() << 32
        held: list = []

        def sizes():
            for batch in batches:
                if batch.num_rows:
                    held.append(batch)
                    yield from batch.column(size).to_pylist()

        parts, made = cuts(sizes(), most_bytes), []
        for part in parts:
            made.append(first + part)
            if len(made) == held[0].num_rows:
                batch = held.pop()
                kept = [i for i, name in enumerate(batch.schema.names) if name != size]
                yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(made, pa.int64())], names=[*[batch.schema.names[i] for i in kept], "part"])
                made = []

    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema], T.StructField("part", T.LongType())])
    return ordered.mapInArrow(cut, schema)


def write_lake(rows: DataFrame, path: str, files: int | None = None, most_rows: int = 0, most_bytes: int | None = None) -> dict:
    """Canonical files: one row for each id (the smallest signature), ranges of (created_at, id), sorted in each; with a manifest beside them.

    With ``most_bytes``, each range is cut into files of that size (before
    compression), a folder for each part. An empty input is refused.
    """
    spark = rows.sparkSession
    if rows.isEmpty():
        raise ValueError("nothing to write")
    store = Store(spark, path)
    if store.exists("_manifest.json"):
        raise FileExistsError(f"{path} is published")
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if most_bytes:
        ordered = sized_parts(one_per_id(rows), most_bytes, n).sortWithinPartitions("part", "created_at", "id")
    else:
        ordered = one_per_id(rows).repartitionByRange(n, "created_at", "id").sortWithinPartitions("created_at", "id")
    writer = ordered.write.mode("overwrite").option("compression", "zstd").option("maxRecordsPerFile", most_rows)
    writer = writer.partitionBy("part") if most_bytes else writer
    writer.option("parquet.bloom.filter.enabled#id", "true").parquet(f"{path}/data")
    back = spark.read.parquet(f"{path}/data")
    facts = back.agg(F.count("*").alias("rows"), F.min("created_at").cast("string").alias("min_created_at"), F.max("created_at").cast("string").alias("max_created_at"), F.bit_xor(F.xxhash64("id")).alias("ids")).first().asDict()
    manifest = {VERSION_KEY: VERSION, **facts}
    store.write("_manifest.json", canonical_json(manifest))
    return manifest


def quarantine(source, path: str) -> int:
    """Write a source's rejects; their number."""
    source.rejects.write.mode("errorifexists").parquet(path)
    return source.rejects.sparkSession.read.parquet(path).count()


def run_id(snapshot_id: str, query_version: str, as_of: int) -> str:
    return digest([snapshot_id, query_version, as_of])[:32]


class Stale(ValueError):
    """What a run was based on is no longer current."""


class Held(RuntimeError):
    """Another writer holds the lease."""


def pointer(spark: SparkSession, base: str) -> dict | None:
    """The newest turn of the pointer: version, run_id, folder, previous, fence."""
    store = Store(spark, base)
    turns = sorted(n for n in store.names("pointer") if n.endswith(".json"))
    return json.loads(store.read(f"pointer/{turns[-1]}")) if turns else None


def history(spark: SparkSession, base: str) -> list[dict]:
    """All turns of the pointer, oldest first."""
    store = Store(spark, base)
    return [json.loads(store.read(f"pointer/{n}")) for n in sorted(store.names("pointer")) if n.endswith(".json")]


def run_folder(run: str) -> str:
    """A folder of a writer's own for a run: writers of the same run don't meet."""
    return f"runs/{run}-{uuid.uuid4().hex[:12]}"


def publish(spark: SparkSession, base: str, run: str, products: dict[str, DataFrame], evidence: dict, expected_current: str | None, folder: str | None = None, lease=None, again: bool = False) -> bool:
    """Write a run's products and turn the pointer to them; False if the run is current already.

    ``expected_current`` names the run that the work was based on. Each turn of
    the pointer is a numbered file that can be made once only, and a run is
    published by making the one behind that of the run it was based on. So of
    several writers that begin at the same run one is taken, and the others are
    refused (Stale), whenever they come; nothing of theirs is seen. Readers
    follow the newest turn, to all products of a run or all of the one before.

    With a ``lease`` the writer must hold it to the end, and is refused if the
    pointer was turned under a higher fencing number. A run that was current
    before is refused too, but ``again``: for products whose sources go back.
    """
    store = Store(spark, base)
    now = pointer(spark, base)
    if now and now["run_id"] == run:
        return False
    _based(now, expected_current)
    if not again and any(turn["run_id"] == run for turn in history(spark, base)):
        raise Stale(f"stale: {run} was current before {now['run_id']}")
    folder, counts = folder or run_folder(run), {}
    for name, df in products.items():
        df.write.mode("overwrite").parquet(f"{store.base}/{folder}/{name}")
        counts[name] = spark.read.parquet(f"{store.base}/{folder}/{name}").count()
    store.write(f"{folder}/evidence.json", canonical_json(evidence | {"rows": counts, "run_id": run}), replace=True)
    fence = 0
    if lease is not None:
        if not lease.held():
            raise Held(f"the lease of {lease.owner} was lost while {run} was written")
        fence = lease.fence
    if now and fence < now["fence"]:
        raise Held(f"the pointer was turned under fencing number {now['fence']}, this writer has {fence}")
    version = now["version"] + 1 if now else 1
    turn = {"version": version, "run_id": run, "folder": folder, "previous": expected_current, "fence": fence}
    if store.create(f"pointer/{version:012d}.json", canonical_json(turn)):
        return True
    now = pointer(spark, base)
    if now["run_id"] == run:
        return False  # another writer has published the same
    _based(now, expected_current)
    raise Stale(f"stale: {expected_current} was published again meanwhile")


def _based(now: dict | None, expected: str | None) -> None:
    if (now["run_id"] if now else None) != expected:
        raise Stale(f"stale: current is {now['run_id'] if now else None}, expected {expected}")


def sweep(spark: SparkSession, base: str, older_than: float, needed: Iterable[str] = (), clock: Callable[[], float] = time.time) -> list[str]:
    """Delete run folders that no turn of the pointer names and that are older than so many seconds: left by writers that failed or were refused."""
    store, named = Store(spark, base), {t["folder"] for t in history(spark, base)} | set(needed)
    gone = []
    for name in store.names("runs"):
        folder = f"runs/{name}"
        if folder not in named and clock() - store.modified(folder) > older_than:
            store.delete(folder)
            gone.append(folder)
    return gone


def current(spark: SparkSession, base: str) -> str | None:
    now = pointer(spark, base)
    return now["run_id"] if now else None


def read_current(spark: SparkSession, base: str, product: str) -> DataFrame:
    now = pointer(spark, base)
    if now is None:
        raise FileNotFoundError("no run is published")
    return spark.read.parquet(f"{base.rstrip('/')}/{now['folder']}/{product}").withColumn("run_id", F.lit(now["run_id"]))


def ledger(applied: DataFrame | None, objects: DataFrame, run: str) -> DataFrame:
    """The applied objects after a run: object_key, first_run, last_run, active."""
    now = objects.select("object_key", F.lit(run).alias("run"))
    if applied is None:
        return now.select("object_key", F.col("run").alias("first_run"), F.col("run").alias("last_run"), F.lit(True).alias("active"))
    both = applied.join(now, "object_key", "full_outer")
    return both.select("object_key", F.coalesce("first_run", "run").alias("first_run"), F.coalesce("run", "last_run").alias("last_run"), F.col("run").isNotNull().alias("active"))


class SourceChanged(ValueError):
    """A source isn't the one that its SHA-256 names."""


def source_sha256(spark: SparkSession, path: str) -> str:
    """The SHA-256 of a file, read in stretches by one task."""

    def summed(frames):
        for frame in frames:
            for at in frame["path"]:
                fs, name = pafs.FileSystem.from_uri(at)
                own = hashlib.sha256()
                with fs.open_input_stream(name) as f:
                    while data := f.read(8 << 20):
                        own.update(data)
                yield pd.DataFrame({"sha256": [own.hexdigest()]})

    return spark.createDataFrame([(path,)], "path string").mapInPandas(summed, "sha256 string").first()[0]


def work_unit(spark: SparkSession, base: str, source_key: str, sha256: str, source, most_bytes: int | None = None, source_path: str | None = None) -> dict:
    """Bring one source to the lake; a run that ended early goes on from its recorded state.

    The unit's id is the source's SHA-256, so the same source gives the same
    unit. With ``source_path`` (a URI) the file's own sum is taken before and
    after it is read, and a source that isn't what it is said to be, or changes
    meanwhile, fails (SourceChanged). ``most_bytes`` cuts the unit's files by
    size. Rejects are written first, then the events; both become visible with
    the unit's state, which is written last.
    """
    store, unit = Store(spark, base), sha256
    name = f"units/{unit}.json"
    state = json.loads(store.read(name)) if store.exists(name) else {"unit": unit, "source_key": source_key, "state": "pending"}

    def to(s: str, **more) -> None:
        state.update(more, state=moved(state["state"], s))
        store.write(name, canonical_json(state), replace=True)

    def unchanged() -> None:
        if source_path and (found := source_sha256(spark, source_path)) != sha256:
            raise SourceChanged(f"{source_key} has SHA-256 {found}, not {sha256}")

    if state["state"] == "source_committed":
        return state
    out = f"{store.base}/objects/{unit}"
    try:
        if state["state"] in ("pending", "failed", "writing"):
            to("writing")
            unchanged()
            for part in ("data", "rejects"):
                store.delete(f"objects/{unit}/{part}")
            store.delete(f"objects/{unit}/_manifest.json")
            rejected = quarantine(source, f"{out}/rejects")
            from eventide.sources.files import lake_rows

            manifest = write_lake(lake_rows(source.events), out, most_bytes=most_bytes)
            unchanged()
            to("validated", rejected=rejected, manifest=manifest)
        for step in ("uploading", "uploaded", "published", "source_committed"):
            if state["state"] != step:
                to(step)
    except Exception as e:
        if state["state"] not in ("published", "source_committed"):
            to("failed", error=type(e).__name__)
        raise
    return state
