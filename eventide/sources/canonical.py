"""Canonical files, written by the tasks and committed by what the tasks report.

Spark's own Parquet writer has neither a key of one's own in the footer nor
unsigned columns, so a data source of ours writes record batches as they come
from the sorted partitions: unsigned columns, all required, the version in the
footer, row groups and files cut by size, and a SHA-256 taken while a file is
written. A task writes to a folder of its attempt and reports its files; the
commit moves the reported ones in place and writes the manifest last. A task
that is lost or done twice reports nothing or once, and its folder goes.

``verify`` holds files to the format's rules, one task a file, and to the sizes and
sums of the manifest.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from eventide.operators.catalog import canonical_json
from eventide.operators.publish import EACH_BYTES, FIXED_BYTES, Store
from eventide.operators.validate import one_per_id
from eventide.schema import VERSION, VERSION_KEY, require

#: Bytes (before compression, as :func:`publish.row_bytes` counts them) of a row group, and of a file where no size is given.
GROUP_BYTES, FILE_BYTES = 128 << 20, 1 << 30
MANIFEST = "_manifest.json"

_TAG = pa.field("element", pa.list_(pa.field("element", pa.string(), False)), False)
STORED = pa.schema([
    pa.field("id", pa.binary(32), False), pa.field("pubkey", pa.binary(32), False), pa.field("created_at", pa.uint64(), False), pa.field("kind", pa.uint16(), False),
    pa.field("tags", pa.list_(_TAG), False), pa.field("content", pa.string(), False), pa.field("sig", pa.binary(64), False),
])


@dataclass
class Written(WriterCommitMessage):
    """The files of a task: staged name, number, rows, byte_size, sha256, min_created_at, max_created_at each."""

    files: list


class _Summed:
    """A file that is hashed as it is written."""

    def __init__(self, out):
        self.out, self.sum, self.size, self.closed = out, hashlib.sha256(), 0, False

    def write(self, data) -> int:
        data = bytes(data)
        self.sum.update(data)
        self.size += len(data)
        self.out.write(data)
        return len(data)

    def tell(self) -> int:
        return self.size

    def flush(self) -> None:
        self.out.flush()

    def close(self) -> None:
        self.closed = True

    def readable(self) -> bool:
        return False

    def writable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return False


def stored(batch: pa.RecordBatch) -> pa.Table:
    """A batch of lake rows in the stored types; ArrowInvalid where a value isn't one of them."""
    columns = [batch.column(f.name).cast(f.type, safe=True) if f.name != "tags" else batch.column("tags").cast(f.type) for f in STORED]
    if any(c.null_count for c in columns) or pc.any(pc.equal(pc.list_value_length(columns[4].flatten()), 0)).as_py():
        raise ValueError("a canonical row has no null and no empty tag")
    return pa.Table.from_arrays(columns, schema=STORED)


def sizes(table: pa.Table) -> np.ndarray:
    """The size of each row, as :func:`publish.row_bytes` has it."""
    column = lambda name: table[name].combine_chunks()
    tags = column("tags")
    lists, texts = tags.values, tags.values.values
    sums = lambda n: np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    by_text = sums(EACH_BYTES + pc.binary_length(texts).to_numpy(zero_copy_only=False))
    by_list = sums(EACH_BYTES + np.diff(by_text[lists.offsets.to_numpy()]))
    return FIXED_BYTES + 2 * EACH_BYTES + pc.binary_length(column("content")).to_numpy(zero_copy_only=False) + np.diff(by_list[tags.offsets.to_numpy()])


def runs(size: np.ndarray, most: int, held: int):
    """Rows a to b of each part, and the part's size: parts keep to the limit, a row over it is one of its own; the first goes on from ``held`` bytes."""
    ends, a = np.cumsum(size), 0
    while a < len(size):
        before = ends[a - 1] if a else 0
        b = int(np.searchsorted(ends, before + most - held, "right"))
        if b <= a and not held:
            b = a + 1
        yield a, b, int(ends[b - 1] - before) if b > a else 0
        a, held = b, 0


class CanonicalWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.most = options["path"].rstrip("/"), int(options.get("mostbytes", 0))
        self.staging = f"{self.path}/_staging/{uuid.uuid4().hex}"

    def write(self, batches) -> Written:
        from pyspark import TaskContext

        fs, at = pafs.FileSystem.from_uri(self.staging)
        own = f"{at}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        fs.create_dir(own, recursive=True)
        done, last, held, size = [], None, [], 0
        partition, most = TaskContext.get().partitionId(), self.most or FILE_BYTES
        for batch in batches:
            rows = stored(batch)
            last = _in_order(rows, last)
            for i, (a, b, more) in enumerate(runs(sizes(rows), most, size)):
                if i:  # what was held is full
                    done.append(_write_file(fs, f"{own}/{len(done):06d}.parquet", held, partition, len(done)))
                    held, size = [], 0
                held += [rows.slice(a, b - a)] if b > a else []
                size += more
        if held:
            done.append(_write_file(fs, f"{own}/{len(done):06d}.parquet", held, partition, len(done)))
        return Written(done)

    def commit(self, messages) -> None:
        fs, at = pafs.FileSystem.from_uri(self.path)
        files = sorted((f for m in messages if m for f in m.files), key=lambda f: (f["partition"], f["number"]))
        fs.create_dir(f"{at}/data", recursive=True)
        listed = []
        for i, f in enumerate(files):
            name = f"data/{i:06d}-{f['sha256'][:16]}.parquet"
            fs.move(f["staged"], f"{at}/{name}")
            listed.append({"name": name, **{k: f[k] for k in ("rows", "byte_size", "sha256", "min_created_at", "max_created_at")}})
        manifest = {VERSION_KEY: VERSION, "rows": sum(f["rows"] for f in listed), "min_created_at": min((int(f["min_created_at"]) for f in listed), default=None), "max_created_at": max((int(f["max_created_at"]) for f in listed), default=None), "files": listed}
        manifest |= {k: None if manifest[k] is None else str(manifest[k]) for k in ("min_created_at", "max_created_at")}
        with fs.open_output_stream(f"{at}/{MANIFEST}.tmp") as out:
            out.write(canonical_json(manifest))
        fs.move(f"{at}/{MANIFEST}.tmp", f"{at}/{MANIFEST}")
        self._clear()

    def abort(self, messages) -> None:
        self._clear()

    def _clear(self) -> None:
        fs, at = pafs.FileSystem.from_uri(self.staging)
        if fs.get_file_info(at).type != pafs.FileType.NotFound:
            fs.delete_dir(at)


def _in_order(rows: pa.Table, last):
    """The last key of the rows; ValueError where they aren't in strict order, behind ``last``."""
    keys = list(zip(rows["created_at"].to_pylist(), rows["id"].to_pylist(), strict=True))
    if any(x >= y for x, y in zip([last, *keys] if last else keys, keys if last else keys[1:], strict=False)):
        raise ValueError("rows aren't in strict order of (created_at, id)")
    return keys[-1] if keys else last


def _write_file(fs, staged: str, parts: list[pa.Table], partition: int, number: int) -> dict:
    with fs.open_output_stream(staged) as raw:
        out = _Summed(raw)
        with pq.ParquetWriter(pa.PythonFile(out, "w"), STORED, compression="zstd", version="2.6", data_page_version="1.0", store_schema=False, write_statistics=True) as writer:
            table = pa.concat_tables(parts)
            for a, b, _ in runs(sizes(table), GROUP_BYTES, 0):
                writer.write_table(table.slice(a, b - a), row_group_size=b - a)
            writer.add_key_value_metadata({VERSION_KEY: VERSION})
    times = [t["created_at"] for t in parts]
    low, high = str(times[0][0].as_py()), str(times[-1][-1].as_py())  # in order of time
    return {"staged": staged, "partition": partition, "number": number, "rows": sum(map(len, parts)), "byte_size": out.size, "sha256": out.sum.hexdigest(), "min_created_at": low, "max_created_at": high}


class Canonical(DataSource):
    """``df.write.format("canonical").option("path", ...)``: lake rows, sorted within partitions, as canonical files."""

    @classmethod
    def name(cls) -> str:
        return "canonical"

    def writer(self, schema, overwrite: bool) -> CanonicalWriter:
        return CanonicalWriter({k.lower(): v for k, v in self.options.items()})


def write_canonical(rows: DataFrame, path: str, files: int | None = None, most_bytes: int | None = None) -> dict:
    """Lake rows as canonical files, one row for each id (the smallest signature); the manifest.

    Files hold ranges of (created_at, id) in order. ``most_bytes`` cuts them by
    their rows' sizes before compression; a task holds one file's rows. An
    empty input is refused, and so is a folder that holds a manifest.
    """
    spark = rows.sparkSession
    store = Store(spark, path)
    if store.exists(MANIFEST):
        raise FileExistsError(f"{path} is published")
    if rows.isEmpty():
        raise ValueError("nothing to write")
    spark.dataSource.register(Canonical)
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = require(one_per_id(rows)).repartitionByRange(n, "created_at", "id").sortWithinPartitions("created_at", "id")
    ordered.write.format("canonical").mode("append").option("path", path).option("mostbytes", str(most_bytes or 0)).save()
    return manifest(spark, path)


def manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(Store(spark, path).read(MANIFEST))


def read_canonical(spark: SparkSession, path: str) -> DataFrame:
    """Lake rows of the files that the manifest names."""
    from eventide.sources.files import lake

    return lake(spark, *[f"{path.rstrip('/')}/{f['name']}" for f in manifest(spark, path)["files"]])


def file_faults(data: bytes | pa.Buffer) -> list[str]:
    """The rules of the format that a file breaks."""
    file, out = pq.ParquetFile(pa.BufferReader(data)), []
    keys = [(k.decode(), v.decode()) for k, v in (file.metadata.metadata or {}).items()]
    if keys != [(VERSION_KEY, VERSION)]:
        out.append("version")
    if not file.schema_arrow.remove_metadata().equals(STORED):
        return [*out, "schema"]
    last = None
    for g in range(file.num_row_groups):
        meta, rows = file.metadata.row_group(g), file.read_row_group(g)
        columns = [meta.column(i) for i in range(meta.num_columns)]
        at = next(c for c in columns if c.path_in_schema == "created_at")
        times, ids = rows["created_at"].to_pylist(), rows["id"].to_pylist()
        if not at.is_stats_set or not at.statistics.has_min_max or (at.statistics.min, at.statistics.max) != (min(times), max(times)):
            out.append("statistics")
        if any(c.compression != "ZSTD" for c in columns):
            out.append("compression")
        try:
            last = _in_order(rows, last)
        except ValueError:
            out.append("order")
            last = (times[-1], ids[-1])
        if any(len(t) == 0 for tags in rows["tags"].to_pylist() for t in tags):
            out.append("empty_tag")
    return sorted(set(out))


def verify(spark: SparkSession, path: str) -> DataFrame:
    """name and fault of the manifest's files: missing, byte_size, sha256, rows, or a rule of the format. No row: all is well.

    Each file is read whole by one task; events' ids are checked by
    :func:`validate.canonical_faults` over all files.
    """
    root = path.rstrip("/")
    listed = [(f["name"], f["rows"], f["byte_size"], f["sha256"]) for f in manifest(spark, path)["files"]]

    def faults(frames):
        for frame in frames:
            found = []
            for name, rows, size, sha in zip(*(frame[c] for c in ("name", "rows", "byte_size", "sha256")), strict=True):
                fs, at = pafs.FileSystem.from_uri(f"{root}/{name}")
                if fs.get_file_info(at).type == pafs.FileType.NotFound:
                    found.append((name, "missing"))
                    continue
                with fs.open_input_stream(at) as f:
                    data = f.read()
                own = [("byte_size", len(data) != size), ("sha256", hashlib.sha256(data).hexdigest() != sha)]
                broken = [fault for fault, is_so in own if is_so]
                try:
                    broken += file_faults(data)
                    broken += ["rows"] if pq.read_metadata(pa.BufferReader(data)).num_rows != rows else []
                except pa.ArrowInvalid:
                    broken.append("unreadable")
                found += [(name, b) for b in broken]
            yield pa.RecordBatch.from_pylist([dict(zip(("name", "fault"), x, strict=True)) for x in found], pa.schema([("name", pa.string()), ("fault", pa.string())])).to_pandas()

    frame = spark.createDataFrame(listed, "name string, rows long, byte_size long, sha256 string").repartition(max(1, min(len(listed), 1000)), F.col("name"))
    return frame.mapInPandas(faults, "name string, fault string")
