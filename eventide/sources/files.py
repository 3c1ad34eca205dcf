"""Sources in files: JSON lines, protobuf, framed segments, the Parquet lake."""

from __future__ import annotations

import gzip
import io
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import IO

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.operators import validate
from eventide.schema import EVENT, require

_JSON = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("pubkey", T.StringType()), T.StructField("created_at", T.LongType()), T.StructField("kind", T.IntegerType()),
    T.StructField("tags", T.ArrayType(T.ArrayType(T.StringType()))), T.StructField("content", T.StringType()), T.StructField("sig", T.StringType()), T.StructField("_bad", T.StringType()),
])
COLUMNS = ["id", "pubkey", "created_at", "kind", "tags", "content", "sig"]


@dataclass
class Source:
    """Rows with a status each; events are those that are ok."""

    rows: DataFrame

    @property
    def events(self) -> DataFrame:
        return self.rows.where("status = 'ok'").select(*COLUMNS)

    @property
    def rejects(self) -> DataFrame:
        return self.rows.where("status <> 'ok'")

    def metrics(self) -> DataFrame:
        return validate.status_counts(self.rows)

    def strict(self) -> DataFrame:
        """The events; ValueError if any row isn't ok."""
        bad = {r["status"]: r["n"] for r in self.metrics().collect() if r["status"] != "ok"}
        if bad:
            raise ValueError(f"rejected rows: {bad}")
        return self.events


def list_files(spark: SparkSession, folder: str, endings: tuple[str, ...], limit: int | None = None) -> list[str]:
    """Files of a folder by name, through Hadoop's file systems."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    found = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)
    return sorted(s.getPath().toString() for s in found if s.isFile() and s.getPath().getName().endswith(endings))[:limit]


def parse_lines(lines: DataFrame, signatures: bool = False) -> Source:
    """Lines (value) of JSON events. Numbers and booleans in tags become strings, nulls there ''; blank lines don't count."""
    made = lines.where(F.trim("value") != "").select("value", F.from_json("value", _JSON, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("e"))
    tags = F.transform("e.tags", lambda t: F.transform(t, lambda x: F.coalesce(x, F.lit(""))))
    rows = made.select(*[F.col(f"e.{c}") for c in COLUMNS if c != "tags"], tags.alias("tags"), "value", F.col("e._bad").alias("_bad"), F.col("e").isNull().alias("_none"))
    checked = validate.check(rows, signatures)
    status = F.when(F.col("_bad").isNotNull() | F.col("_none"), "invalid_json").otherwise(F.col("status"))
    return Source(checked.withColumn("status", status).select(*COLUMNS, "value", "status"))


def jsonl(spark: SparkSession, folder: str, limit: int | None = None, signatures: bool = False) -> Source:
    paths = list_files(spark, folder, (".jsonl", ".json", ".ndjson"), limit)
    if not paths:
        raise FileNotFoundError(f"no JSON lines in {folder}")
    return parse_lines(spark.read.text(paths), signatures)


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        at += 1
        value |= (b & 127) << shift
        if b < 128:
            return value, at
        shift += 7
        if shift > 63:
            raise ValueError("varint too long")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    at = 0
    while at < len(data):
        key, at = varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = varint(data, at)
        elif kind == 2:
            size, at = varint(data, at)
            if at + size > len(data):
                raise ValueError("field goes over the end")
            value, at = data[at : at + size], at + size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind}")
        yield key >> 3, value


def decode_event(data: bytes) -> dict:
    """A protobuf event: strings 1 id, 2 pubkey, 6 content, 7 sig; numbers 3 created_at, 4 kind; 5 tags of strings 1."""
    out = {"id": "", "pubkey": "", "created_at": 0, "kind": 0, "tags": [], "content": "", "sig": ""}
    names = {1: "id", 2: "pubkey", 3: "created_at", 4: "kind", 6: "content", 7: "sig"}
    for n, value in _fields(data):
        if n == 5:
            out["tags"].append([v.decode() for k, v in _fields(value) if k == 1])
        elif n in names:
            out[names[n]] = value.decode() if isinstance(value, bytes) else value - (1 << 64) if value >> 63 else value
    return out


def encode_event(e: dict) -> bytes:
    text = lambda k, b: _number(k << 3 | 2) + _number(len(b)) + b
    out = b"".join(text(k, e[n].encode()) for k, n in ((1, "id"), (2, "pubkey")) if e[n])
    out += _number(3 << 3) + _number(e["created_at"]) + _number(4 << 3) + _number(e["kind"])
    out += b"".join(text(5, b"".join(text(1, v.encode()) for v in t)) for t in e["tags"])
    return out + b"".join(text(k, e[n].encode()) for k, n in ((6, "content"), (7, "sig")) if e[n])


class _Cursor:
    """Reads a packed note; what goes over its end is an error."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def number(self) -> int:
        value, self.at = varint(self.data, self.at)
        if value >> 64:
            raise ValueError("a number over 64 bits")
        return value

    def take(self, size: int) -> bytes:
        if self.at + size > len(self.data):
            raise IndexError("a field goes over the end")
        self.at += size
        return self.data[self.at - size : self.at]

    def count(self) -> int:
        n = self.number()
        if n > len(self.data) - self.at:
            raise IndexError("more items than bytes")
        return n

    def element(self) -> str:
        size = self.number()
        raw = self.take(size >> 1)
        return raw.hex() if size & 1 else raw.decode()


def decode_note(data: bytes) -> dict:
    """A packed note, version 1.

    Numbers are varints: the version; id, public key and signature, raw; time
    and kind; the content behind its size; the number of tags, of each the
    number of its elements, each behind twice its size, plus one where it is
    raw bytes that stand for hexadecimal text. Nothing may follow.
    """
    c = _Cursor(data)
    if (version := c.number()) != 1:
        raise ValueError(f"version {version}")
    out = {"id": c.take(32).hex(), "pubkey": c.take(32).hex(), "sig": c.take(64).hex(), "created_at": c.number(), "kind": c.number()}
    if out["kind"] > 0xFFFF:
        raise ValueError("kind over 65535")
    if out["created_at"] >> 63:
        out["created_at"] -= 1 << 64
    out["content"] = c.take(c.number()).decode()
    out["tags"] = [[c.element() for _ in range(c.count())] for _ in range(c.count())]
    if c.at != len(data):
        raise ValueError("bytes behind the end")
    return out


def _number(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def encode_note(e: dict) -> bytes:
    """The inverse of decode_note; elements that are lower-case hexadecimal of whole bytes are packed raw."""
    raw = lambda v: bytes.fromhex(v) if v and len(v) % 2 == 0 and re.fullmatch("[0-9a-f]+", v) else None
    element = lambda v: _number(len(r) * 2 + 1) + r if (r := raw(v)) is not None else _number(len(v.encode()) * 2) + v.encode()
    out = _number(1) + bytes.fromhex(e["id"]) + bytes.fromhex(e["pubkey"]) + bytes.fromhex(e["sig"]) + _number(e["created_at"]) + _number(e["kind"])
    out += _number(len(e["content"].encode())) + e["content"].encode() + _number(len(e["tags"]))
    return out + b"".join(_number(len(t)) + b"".join(map(element, t)) for t in e["tags"])


def frames(stream: IO[bytes], prefix: str, most: int) -> Iterator[tuple[int, bytes | None, str]]:
    """(offset, payload, status) of each frame, read one at a time; what is cut off or too large ends the file with a row of its own."""
    at = 0
    while True:
        start, head = at, b""
        try:
            while len(head) < (4 if prefix == "u32" else 10):
                b = stream.read(1)
                head += b
                if not b or prefix == "varint" and b[0] < 128:
                    break
            if not head:
                return
            if prefix == "varint":
                size, _ = varint(head, 0)
            elif len(head) < 4:
                raise IndexError
            else:
                size = int.from_bytes(head, "little")
        except (IndexError, ValueError, EOFError, zlib.error):
            yield start, head, "truncated"
            return
        if size > most:
            yield start, None, "oversize"
            return
        try:
            payload = stream.read(size)
        except (EOFError, zlib.error):
            payload = b""
        if len(payload) < size:
            yield start, head + payload, "truncated"
            return
        yield start, payload, "ok"
        at += len(head) + size


_FRAME = T.StructType([T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), *[f for f in _JSON if f.name != "_bad"], T.StructField("payload", T.BinaryType()), T.StructField("frame", T.StringType())])


#: Ways to read a message.
MESSAGES = {"protobuf": decode_event, "note": decode_note}


def _framed(prefix: str, most: int, message: str):
    texts = pa.list_(pa.list_(pa.string()))
    kinds = {"offset": pa.int64(), "created_at": pa.int64(), "kind": pa.int32(), "tags": texts, "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in _FRAME.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for files in batches:
            # Where a stretch of a file comes, its first byte stands beside it.
            begins = files.column(2).to_pylist() if files.num_columns > 2 else [0] * files.num_rows
            for path, content, begin in zip(files.column(0).to_pylist(), files.column(1).to_pylist(), begins, strict=True):
                # Packed content is unpacked as it is read, never whole.
                stream = io.BytesIO(content)
                stream = io.BufferedReader(gzip.GzipFile(fileobj=stream)) if content[:2] == b"\x1f\x8b" else stream
                rows = []
                for offset, payload, status in frames(stream, prefix, most):
                    row = {"path": path, "offset": begin + offset, "frame": status}
                    if status == "ok":
                        try:
                            row |= MESSAGES[message](payload)
                        except (ValueError, IndexError, UnicodeDecodeError):
                            row["frame"] = "invalid_message"
                    if row["frame"] != "ok":
                        row["payload"] = payload
                    rows.append(row)
                    if len(rows) == 5000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _messages(spark: SparkSession, paths: list[str], prefix: str, most: int, signatures: bool, message: str) -> Source:
    return _checked(spark.read.format("binaryFile").load(paths).select("path", "content").mapInArrow(_framed(prefix, most, message), _FRAME), signatures)


def _checked(rows: DataFrame, signatures: bool) -> Source:
    checked = validate.check(rows, signatures)
    return Source(checked.withColumn("status", F.when(F.col("frame") != "ok", F.col("frame")).otherwise(F.col("status"))).drop("frame"))


def protobuf(spark: SparkSession, folder: str, limit: int | None = None, most: int = 16 << 20, signatures: bool = False) -> Source:
    """Length-delimited protobuf events, gzipped or plain."""
    return _messages(spark, list_files(spark, folder, (".pb", ".gz"), limit), "varint", most, signatures, "protobuf")


def segments(spark: SparkSession, folder: str, limit: int | None = None, most: int = 16 << 20, signatures: bool = False, salvage: bool = False, message: str = "note") -> Source:
    """Framed segments (a 32-bit size before each message), gzipped or plain, of packed notes or protobuf messages. Without salvage a segment that is cut off is refused; with it the whole frames before the cut count."""
    out = _messages(spark, list_files(spark, folder, (".seg", ".gz", ".notepack"), limit), "u32", most, signatures, message)
    return out if salvage else _whole(out)


def _whole(out: Source) -> Source:
    """The source; ValueError if one of its segments is cut off."""
    broken = [r["path"] for r in out.rows.where("status IN ('truncated', 'oversize')").select("path").distinct().limit(5).collect()]
    if broken:
        raise ValueError(f"segments are cut off: {broken}")
    return out


def frame_index(spark: SparkSession, folder: str, every: int = 8 << 20, most: int = 16 << 20, limit: int | None = None) -> DataFrame:
    """Where plain segments can be cut: path, size, first and last (byte) of stretches of whole frames of about ``every`` bytes.

    A task goes through a file's frame sizes and skips what is between; the
    last stretch goes to the end of the file, with whatever is cut off there.
    Gzipped segments can't be cut and are one stretch. To be kept beside the
    segments; a file of another size than it had then is refused.
    """
    paths = list_files(spark, folder, (".seg", ".gz", ".notepack"), limit)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, at = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(at) as f:
                    size, cuts = f.size(), [0]
                    packed = f.read(2) == b"\x1f\x8b"
                    place = size if packed else 0
                    while place + 4 <= size:
                        f.seek(place)
                        n = int.from_bytes(f.read(4), "little")
                        if n > most or place + 4 + n > size:
                            break
                        place += 4 + n
                        if place - cuts[-1] >= every and place < size:
                            cuts.append(place)
                ends = [*cuts[1:], size]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(cuts)), pa.array([size] * len(cuts), pa.int64()), pa.array(cuts, pa.int64()), pa.array(ends, pa.int64())], names=["path", "size", "first", "last"])

    files = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)), "path")
    return files.mapInArrow(walk, "path string, size long, first long, last long")


def indexed_segments(index: DataFrame, most: int = 16 << 20, signatures: bool = False, salvage: bool = False, message: str = "note", tasks: int | None = None) -> Source:
    """Segments by their index, each stretch read by itself: the same rows, rejects and offsets as :func:`segments` has, in as many tasks as there are stretches, or ``tasks``."""
    n = tasks or max(1, min(index.count(), 100_000))
    decode = _framed("u32", most, message)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, first, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, at = pafs.FileSystem.from_uri(path)
                with fs.open_input_file(at) as f:
                    if f.size() != size:
                        raise ValueError(f"{path} has {f.size()} bytes, {size} when it was indexed")
                    f.seek(first)
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([f.read(last - first)], pa.large_binary()), pa.array([first])], names=["path", "content", "first"])

    dealt = index.select("path", "size", "first", "last").repartition(n, "path", "first")
    out = _checked(dealt.mapInArrow(lambda batches: decode(read(batches)), _FRAME), signatures)
    return out if salvage else _whole(out)


def _lake(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    return spark.read.schema(EVENT).option("mergeSchema", "false").parquet(*paths)


def lake(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows of canonical Parquet files; nothing is inferred or merged, created_at may be stored unsigned."""
    return _lake(spark, paths).select(*EVENT.names)


def lake_with_files(spark: SparkSession, *paths: str) -> DataFrame:
    return _lake(spark, paths).select(*EVENT.names, F.col("_metadata.file_path").alias("file"))


def footer_facts(spark: SparkSession, *paths: str, bounds: tuple[str, ...] = ()) -> DataFrame:
    """One row: rows, and min_ and max_ of the bounds, from the footers of Parquet files; no row group is read.

    The aggregate is pushed into the scan by the second reader, which a session
    of its own turns on. Bounds are of numbers or dates, whose statistics a
    footer has exactly; ValueError if Spark would read rows for what is asked.
    Rows count as they are stored: an id that stands twice counts twice.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    wanted = [F.count("*").alias("rows")] + [f(c).alias(f"{name}_{c}") for c in bounds for name, f in (("min", F.min), ("max", F.max))]
    out = own.read.parquet(*paths).agg(*wanted)
    plan = out._jdf.queryExecution().optimizedPlan().toString() + out._jdf.queryExecution().executedPlan().toString()
    if "PushedAggregation: [COUNT(*)" not in plan:
        raise ValueError(f"the footers don't hold this: {bounds}")
    return out


def lake_rows(events: DataFrame) -> DataFrame:
    """Hexadecimal events as rows of the lake."""
    out = events.select(F.unhex("id").alias("id"), F.unhex("pubkey").alias("pubkey"), F.col("created_at").cast("decimal(20,0)").alias("created_at"), F.col("kind").cast("int").alias("kind"), "tags", "content", F.unhex("sig").alias("sig"))
    return require(out)


def values(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
