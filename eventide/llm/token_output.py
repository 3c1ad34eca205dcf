"""Token ids in binary files of patched frame-of-reference blocks.

Documents are dealt by ranges of doc_id, so shard order is doc_id order; each
shard is a row of segments, each about ``SEGMENT`` ids of whole documents. A
segment is one self-contained byte string:

=================  ==========================================================
``PFR1``           magic
u32, u32, u64      documents, blocks, ids
i64 x documents    doc_id
u8 x documents     1 where doc_id is null
u64 x documents    ids of the document, end id included
u32 x blocks + 1   where each block starts behind this table; the end
blocks             of ``BLOCK`` ids each, the last one filled up with its minimum
=================  ==========================================================

A block is: u32 minimum, u8 width, u8 exceptions; the ids less the minimum,
their low ``width`` bits, packed from the lowest bit on; then a u8 place and
the u32 bits above the width for each exception. The width is the least that
holds ``PERCENTILE`` of the block; the rest are exceptions. Everything is
little-endian. The block starts let a reader decode any block by itself.

Segments are rows of uncompressed Parquet files, so Spark's committer makes
them whole or not at all, on any store, whichever executors are lost.

* A null text counts as an empty text: the end id alone.
* Order: doc_id, null first, then text; rows that repeat stay beside each other.
* An empty table makes no segments and reads back as no rows.
* Columns beside doc_id and text aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm import word_bpe
from eventide.llm.byte_bpe import slices
from eventide.llm.common import load, partitions, shared_path

BLOCK, PERCENTILE, SEGMENT = 128, 0.9, 1 << 19
_SEGMENTS = "shard int, seq int, shard_base long, n_ids long, payload binary"


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths of unsigned integers below 2**32."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack_blocks(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The blocks of ids (uint32), and where each starts and the last ends."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return b"", np.zeros(1, np.uint32)
    full = np.empty(n * BLOCK, np.uint32)
    full[: len(ids)] = ids
    full[len(ids) :] = ids[(n - 1) * BLOCK :].min()
    v = full.reshape(n, BLOCK)
    base = v.min(axis=1)
    v = v - base[:, None]
    nth = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = _bits(np.partition(v, nth, axis=1)[:, nth])
    over = (v.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    row, place = np.nonzero(over)
    patches = np.bincount(row, minlength=n)
    sizes = 6 + width * (BLOCK // 8) + 5 * patches
    starts = np.append(0, np.cumsum(sizes))
    out = np.zeros(starts[-1], np.uint8)
    out[starts[:-1, None] + np.arange(4)] = base.astype("<u4").view(np.uint8).reshape(n, 4)
    out[starts[:-1] + 4] = width
    out[starts[:-1] + 5] = patches
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            bits = np.unpackbits(np.ascontiguousarray(v[own]).astype("<u4").view(np.uint8).reshape(len(own), BLOCK, 4), axis=2, bitorder="little")[:, :, :w]
            packed = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little")
            out[starts[own, None] + 6 + np.arange(packed.shape[1])] = packed
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(patches) - patches, patches)
        tail = starts[row] + 6 + width[row] * (BLOCK // 8)
        out[tail + nth] = place
        at = tail + patches[row] + 4 * nth
        out[at[:, None] + np.arange(4)] = over[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes(), starts.astype(np.uint32)


def unpack_blocks(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The ids of the blocks at starts, whole blocks each."""
    n, s = len(starts), starts.astype(np.int64)
    base = np.ascontiguousarray(raw[s[:, None] + np.arange(4)]).view("<u4").ravel()
    width, patches = raw[s + 4].astype(np.int64), raw[s + 5].astype(np.int64)
    v = np.zeros((n, BLOCK), np.uint32)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            bits = np.zeros((len(own), BLOCK, 32), np.uint8)
            bits[:, :, :w] = np.unpackbits(raw[s[own, None] + 6 + np.arange(w * (BLOCK // 8))], axis=1, bitorder="little").reshape(len(own), BLOCK, w)
            v[own] = np.packbits(bits.reshape(len(own), -1), axis=1, bitorder="little").view("<u4")
    total = int(patches.sum())
    if total:
        row = np.repeat(np.arange(n), patches)
        nth = np.arange(total) - np.repeat(np.cumsum(patches) - patches, patches)
        tail = s[row] + 6 + width[row] * (BLOCK // 8)
        high = np.ascontiguousarray(raw[(tail + patches[row] + 4 * nth)[:, None] + np.arange(4)]).view("<u4").ravel()
        v[row, raw[tail + nth]] += (high.astype(np.uint64) << width[row].astype(np.uint64)).astype(np.uint32)
    return (v + base[:, None]).ravel()


def pack_segment(docs: list[tuple[int | None, int]], ids: np.ndarray) -> bytes:
    """docs: doc_id and number of ids of each document."""
    blocks, starts = pack_blocks(ids)
    head = b"PFR1" + np.array([len(docs), len(starts) - 1], "<u4").tobytes() + np.array([len(ids)], "<u8").tobytes()
    keys = np.array([0 if d is None else d for d, _ in docs], "<i8").tobytes() + np.array([d is None for d, _ in docs], np.uint8).tobytes()
    return head + keys + np.array([n for _, n in docs], "<u8").tobytes() + starts.astype("<u4").tobytes() + blocks


def unpack_segment(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """doc_id of each document, its number of ids, and all ids."""
    if payload[:4] != b"PFR1":
        raise ValueError("not a segment of token ids")
    n_docs, n_blocks = np.frombuffer(payload, "<u4", 2, 4)
    n_ids = int(np.frombuffer(payload, "<u8", 1, 12)[0])
    at = 20
    keys, null = np.frombuffer(payload, "<i8", n_docs, at), np.frombuffer(payload, np.uint8, n_docs, at + 8 * int(n_docs))
    at += 9 * int(n_docs)
    counts = np.frombuffer(payload, "<u8", n_docs, at).astype(np.int64)
    at += 8 * int(n_docs)
    starts = np.frombuffer(payload, "<u4", n_blocks + 1, at)
    ids = unpack_blocks(np.frombuffer(payload, np.uint8, -1, at + 4 * (int(n_blocks) + 1)), starts[:-1])[:n_ids] if n_ids else np.empty(0, np.uint32)
    return [None if z else int(k) for k, z in zip(keys, null, strict=True)], counts, ids


def _write(path: str, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        bpe, shard = word_bpe.loaded(path), TaskContext.get().partitionId()
        docs, parts, held, seq, base = [], [], 0, 0, 0

        def segment():
            ids = np.frombuffer(b"".join(parts), "<u4")
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([seq], pa.int32()), pa.array([base], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([pack_segment(docs, ids)], pa.binary())],
                names=["shard", "seq", "shard_base", "n_ids", "payload"],
            )

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for a, z in slices(texts):
                for key, ids in zip(keys[a:z], bpe.encode_batch(texts[a:z]), strict=True):
                    docs.append((key, len(ids) // 4 + 1))
                    parts += (ids, end)
                    held += len(ids) // 4 + 1
                    if held >= SEGMENT:
                        yield segment()
                        docs, parts, held, seq, base = [], [], 0, seq + 1, base + held
        if docs:
            yield segment()

    return run


def write_ids(docs: DataFrame, out: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of all documents, each with end_id behind it, in ascending order of doc_id."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(partitions(docs), F.asc_nulls_first("doc_id")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "text")
    ordered.mapInArrow(_write(tokenizer, end_id), _SEGMENTS).write.option("compression", "uncompressed").parquet(out)


def _read(batches):
    for batch in batches:
        for base, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            keys, counts, ids = unpack_segment(payload.as_py())
            ends = np.cumsum(counts)
            offsets = np.append(0, ends * 4).astype(np.int32)
            raw = pa.BinaryArray.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(base + ends - counts, pa.int64()), pa.array(counts, pa.int64()), raw], names=["doc_id", "start", "n_tokens", "ids"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (packed unsigned 32-bit) of each document."""
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    totals = segments.groupBy("shard").agg(F.max(F.col("shard_base") + F.col("n_ids")).alias("n"))
    # A row for each shard, so both the window over them and the broadcast are bounded by their number.
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = totals.select("shard", before.alias("before"))
    placed = segments.join(F.broadcast(bases), "shard").select((F.col("before") + F.col("shard_base")).alias("base"), "payload")
    return placed.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids binary")


def op3_token_output(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = shared_path(spark, "token-ids")
    write_ids(load(spark, sf_dir, "documents"), out, public_tokenizers.path("word_bpe_49k.json"), 2)
    return read_ids(spark, out).select("doc_id", "start", "n_tokens", word_bpe.ids_crc32().alias("ids_crc32"))
