"""Substring dedup: remove words that a repeated passage covers, found through fixed-block anchors.

Words are ``[^\\x20\\x09-\\x0D]+``. With windows of ``window`` words, blocks of
``(window + 1) // 2`` words at fixed places (0, b, 2b, ... of each document)
are the reference blocks: every window holds one whole. Every rolling window
of that length probes them. Where a probe meets a block of another place, the
hit is extended both ways: every full window that holds the block, up to the
one that ends with it and the one that begins with it, is compared with the
windows around all blocks that were hit. Overlapping equal windows join up
into maximal exact repeats; what none covers isn't one. Windows are judged on
the input, not on what is left.

Both comparisons are dealt by hash. A document sends each of its hashes once,
packed into few rows, so a passage that a third of all documents share costs
one entry a document, and no pairs are made. Anchors compare 31 bits beside
those of the partition; a chance hit there only makes a candidate. Full
windows compare 127 bits, of two independent hashes.

* A null text has no words; such rows, and those of fewer words than
  ``window``, come back unchanged. An empty table gives an empty result.
* Rows that repeat, even with the same doc_id, are copies of each other.
* Very long texts are hashed whole; a task holds the hashes of ``PACK`` words
  or of one text, whichever is more.
* A text that loses words keeps the white space around what stays; where two
  kept parts would touch, nothing is added as white space stays between.
* Columns beside doc_id and text are kept; ``n_words``, ``n_removed`` and
  ``kept_sha256`` are the operator's own and replace columns of those names.
  Names used inside yield to those of the frame.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import load, mix64, partitions, rolling, row_key, spare

#: Words of a passage that counts as repeated.
WINDOW = 35
#: Odd multipliers of the polynomials: of blocks, and two of windows.
BLOCK_BASE, WINDOW_BASE, SECOND_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA0761D6478BD642F
#: Hashes packed before rows go out: bounds a task's memory.
PACK = 1 << 20

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_PACKED = "bucket int, source int, doc_id binary, rid binary, counts binary, hashes binary"


def _word_hashes(text: str) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").split()
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def _flagged(values: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Distinct hashes (63 bits, sorted), each with a low bit that is set if any of its places has the flag."""
    v = (values & ~np.uint64(1)) | flags.astype(np.uint64)
    v.sort()
    top = v >> np.uint64(1)
    return v[np.append(top[1:] != top[:-1], True)] if len(v) else v


def _blocks(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    b = (window + 1) // 2
    probes = rolling(h, b, BLOCK_BASE)
    aligned = np.zeros(len(probes), bool)
    aligned[::b] = True
    return probes, aligned


#: A window's two hashes.
_WINDOW = np.dtype([("a", np.uint64), ("b", np.uint64)])


def _windows(h: np.ndarray, window: int) -> np.ndarray:
    out = np.empty(max(len(h) - window + 1, 0), _WINDOW)
    out["a"] = rolling(h, window, WINDOW_BASE) & ~np.uint64(1)
    out["b"] = rolling(mix64(h + np.uint64(SECOND_BASE)), window, SECOND_BASE)
    return out


def _ordered(values: np.ndarray) -> np.ndarray:
    """Places of the values, or windows, in ascending order; of equals the first place first."""
    return np.argsort(values, kind="stable") if values.dtype != _WINDOW else np.lexsort((values["b"], values["a"]))


def _repeated(values: np.ndarray) -> np.ndarray:
    """Whether each value, or window, stands in the array twice or more."""
    order = _ordered(values)
    same = values[order[1:]] == values[order[:-1]]
    out = np.zeros(len(values), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _bucket_of(flagged: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix64(flagged >> np.uint64(1)) >> np.uint64(20)) % np.uint64(buckets)).astype(np.int32)


def _packed(to: np.ndarray, owner: np.ndarray, ids: np.ndarray, null: np.ndarray, rids: np.ndarray, values: np.ndarray, source: int = -1) -> Iterator[pa.RecordBatch]:
    """A row for each place that values go to, with all of them by owning document; owner is sorted."""
    if not len(values):
        return
    order = np.argsort(to, kind="stable")
    values, owner, to = values[order], owner[order], to[order]
    starts = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
    out: list[tuple] = []
    for a, z in zip(starts, np.append(starts[1:], len(values)), strict=True):
        first = np.flatnonzero(np.append(True, owner[a + 1 : z] != owner[a : z - 1]))
        who = owner[a:z][first]
        counts = np.diff(np.append(first, z - a)).astype(np.int32)
        # A null doc_id is told from others by the sign of its count.
        counts[null[who]] *= -1
        out.append((int(to[a]), source, ids[who].tobytes(), rids[who].tobytes(), counts.tobytes(), values[a:z].tobytes()))
    kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=["bucket", "source", "doc_id", "rid", "counts", "hashes"])


def _unpacked(rows: list[tuple], kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_id, row key and signed count of each document, and all values, of rows as packed."""
    return tuple(np.concatenate([np.frombuffer(r[i], k) for r in rows]) for i, k in enumerate((np.int64, np.int64, np.int32, kind)))


def _held(batches) -> dict[int, list[tuple]]:
    """Packed rows by bucket, each with its source last."""
    held: dict[int, list[tuple]] = {}
    for batch in batches:
        buckets, sources, *parts = (batch.column(i) for i in range(6))
        for i in range(batch.num_rows):
            held.setdefault(buckets[i].as_py(), []).append((*(p[i].as_py() for p in parts), sources[i].as_py()))
    return held


class _Packer:
    """Gathers the hashes of documents and packs them into a row for each bucket."""

    def __init__(self, buckets: int, narrow: bool):
        self.buckets, self.narrow = buckets, narrow
        self.clear()

    def clear(self):
        self.docs: list[tuple[int | None, int]] = []
        self.parts: list[np.ndarray] = []
        self.n = 0

    def add(self, doc: int | None, rid: int, flagged: np.ndarray) -> bool:
        self.docs.append((doc, rid))
        self.parts.append(flagged)
        self.n += len(flagged)
        return self.n >= PACK

    def rows(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            v = np.concatenate(self.parts)
            first = v if self.narrow else v["a"]
            owner = np.repeat(np.arange(len(self.parts), dtype=np.int32), [len(p) for p in self.parts])
            ids = np.array([0 if d is None else d for d, _ in self.docs], np.int64)
            null = np.array([d is None for d, _ in self.docs])
            rids = np.array([r for _, r in self.docs], np.int64)
            yield from _packed(_bucket_of(first, self.buckets), owner, ids, null, rids, v.astype(np.uint32) if self.narrow else v)
        self.clear()


def _rows(batches) -> Iterator[dict]:
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        names = batch.schema.names
        for i in range(batch.num_rows):
            yield {n: c[i].as_py() for n, c in zip(names, columns, strict=True)}


def _send_blocks(window: int, buckets: int):
    def run(batches):
        packer = _Packer(buckets, narrow=True)
        for row in _rows(batches):
            h = _word_hashes(row["text"])
            if len(h) >= window and packer.add(row["doc_id"], row["rid"], _flagged(*_blocks(h, window))):
                yield from packer.rows()
        yield from packer.rows()

    return run


def _meet(anchors: bool, buckets: int):
    """Of a bucket's hashes, those that another document has too; of anchors, has as a reference block.

    Anchors go back as hashes without their flag, windows as ordinals among the
    hashes that the document sent to this bucket; both in a row for each place
    that documents are gathered at.
    """
    kind = np.uint32 if anchors else _WINDOW

    def run(batches):
        held = _held(batches)
        for bucket in list(held):
            ids, rids, counts, v = _unpacked(held.pop(bucket), kind)
            sizes = np.abs(counts).astype(np.int64)
            # Each entry is a row of the table of its own, even where rows repeat.
            owner = np.repeat(np.arange(len(counts), dtype=np.int32), sizes)
            compared = v >> kind(1) if anchors else v
            order = _ordered(compared)
            top = compared[order]
            group = np.cumsum(np.append(True, top[1:] != top[:-1])) - 1
            who = owner[order].astype(np.int64)
            counted = (v[order] & kind(1)).astype(bool) if anchors else np.ones(len(v), bool)
            # Lowest and highest of the rows that count, for each hash: another one is there if either differs.
            low, high = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max), np.full(int(group[-1]) + 1, -1, np.int64)
            np.minimum.at(low, group[counted], who[counted])
            np.maximum.at(high, group[counted], who[counted])
            at = np.sort(order[(high[group] >= 0) & ((low[group] != who) | (high[group] != who))])
            own = owner[at]
            values = v[at] >> kind(1) if anchors else (at - (np.cumsum(sizes) - sizes)[own]).astype(np.uint32)
            to = (mix64(rids.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            yield from _packed(to[own], own, ids, counts < 0, rids, values, bucket)

    return run


def _gather(batches):
    """A row for each document: source bucket, number and values, one bucket after the other."""
    for rows in _held(batches).values():
        parts: dict[tuple, list[bytes]] = {}
        for row in rows:
            ids, rids, counts, _ = _unpacked([row], np.uint32)
            at, values = 0, row[3]
            for key, rid, n in zip(ids.tolist(), rids.tolist(), counts.tolist(), strict=True):
                m = abs(n)
                parts.setdefault((None if n < 0 else key, rid), []).append(np.array([row[4], m], np.uint32).tobytes() + values[at : at + 4 * m])
                at += 4 * m
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in parts], pa.int64()), pa.array([k[1] for k in parts], pa.int64()), pa.array([b"".join(p) for p in parts.values()], pa.binary())], names=["doc_id", "rid", "hashes"]
        )


def _by_bucket(blob: bytes | None) -> list[tuple[int, np.ndarray]]:
    found, v, at = [], np.frombuffer(blob or b"", np.uint32), 0
    while at < len(v):
        n = int(v[at + 1])
        found.append((int(v[at]), v[at + 2 : at + 2 + n]))
        at += 2 + n
    return found


def _candidates(h: np.ndarray, anchors: bytes | None, window: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows, and the distinct ones of those that hold a block that was hit."""
    b = (window + 1) // 2
    probes, _ = _blocks(h, window)
    hit = _repeated(probes)
    if anchors:
        hit |= np.isin((probes >> np.uint64(1)).astype(np.uint32) & np.uint32(0x7FFFFFFF), np.concatenate([v for _, v in _by_bucket(anchors)]))
    upto = np.append(0, np.cumsum(hit))
    near = upto[window - b + 1 :] - upto[: -(window - b + 1)] > 0
    if not near.any():
        return np.empty(0, _WINDOW), np.empty(0, _WINDOW)
    values = _windows(h, window)
    sent = values[near]
    sent = sent[_ordered(sent)]
    return values, sent[np.append(True, sent[1:] != sent[:-1])]


def _send_windows(window: int, buckets: int):
    def run(batches):
        packer = _Packer(buckets, narrow=False)
        for row in _rows(batches):
            h = _word_hashes(row["text"])
            if len(h) >= window:
                flagged = _candidates(h, row["anchors"], window)[1]
                if len(flagged) and packer.add(row["doc_id"], row["rid"], flagged):
                    yield from packer.rows()
        yield from packer.rows()

    return run


def _cover(text: str, anchors: bytes | None, found: bytes | None, window: int, buckets: int) -> tuple[int, np.ndarray]:
    """Words of a text, and which of them repeated windows cover."""
    h = _word_hashes(text)
    gone = np.zeros(len(h), bool)
    if len(h) < window:
        return len(h), gone
    values, sent = _candidates(h, anchors, window)
    if len(sent):
        hit = _repeated(values)
        if found:
            to = _bucket_of(sent["a"], buckets)
            met = np.zeros(len(sent), bool)
            for bucket, at in _by_bucket(found):
                met[np.flatnonzero(to == bucket)[at]] = True
            # The place of each window among those that were sent.
            order = _ordered(np.concatenate([sent, values]))
            upto = np.cumsum(order < len(sent)) - 1
            place = np.empty(len(order), np.int64)
            place[order] = upto
            place = place[len(sent) :]
            hit |= (place >= 0) & (sent[place] == values) & met[place]
        steps = np.zeros(len(h) + 1, np.int64)
        at = np.flatnonzero(hit)
        np.add.at(steps, at, 1)
        np.add.at(steps, at + window, -1)
        gone = np.cumsum(steps[:-1]) > 0
    return len(h), gone


def _without(text: str, gone: np.ndarray) -> str:
    """The text without the words that go, each with the white space before it."""
    if not gone.any():
        return text
    raw, out, last = text.encode("utf-8", "surrogatepass"), [], 0
    for m, g in zip(_WORD.finditer(raw), gone, strict=True):
        if not g:
            out.append(raw[last : m.end()])
        last = m.end()
    out.append(raw[last:])
    return b"".join(out).decode("utf-8", "surrogatepass")


def _finish(window: int, buckets: int, columns: list[str], inside: tuple[str, str, str]):
    def run(batches):
        for batch in batches:
            texts, anchors, found = (batch.column(c).to_pylist() for c in inside)
            n_words, n_removed, kept, shas = [], [], [], []
            for text, a, r in zip(texts, anchors, found, strict=True):
                n, gone = _cover(text or "", a, r, window, buckets)
                left = text if text is None else _without(text, gone)
                n_words.append(n)
                n_removed.append(int(gone.sum()))
                kept.append(left)
                shas.append(hashlib.sha256(b" ".join((left or "").encode("utf-8", "surrogatepass").split())).hexdigest())
            own = {"text": pa.array(kept, pa.string()), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_sha256": pa.array(shas, pa.string())}
            yield pa.RecordBatch.from_arrays([own[c] if c in own else batch.column(c) for c in columns], names=columns)

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs with the words of repeated passages removed from text, plus n_words, n_removed and kept_sha256 (of the kept words, joined by one space)."""
    docs = docs.drop("n_words", "n_removed", "kept_sha256")
    text, rid, hit_id, hit_rid, anchors, repeats = spare(docs, "text", "rid", "hit_id", "hit_rid", "anchors", "repeats")
    rows = docs.withColumnsRenamed({"text": text}).withColumn(text, F.col(text).cast("string")).withColumn(rid, row_key(text))
    buckets = partitions(docs)

    def met(sent: DataFrame, by_anchor: bool) -> DataFrame:
        """A row for each document with hits."""
        dealt = lambda df: df.repartitionById(buckets, F.col("bucket"))
        return dealt(dealt(sent).mapInArrow(_meet(by_anchor, buckets), _PACKED)).mapInArrow(_gather, "doc_id long, rid long, hashes binary")

    def joined(left: DataFrame, hits: DataFrame, name: str) -> DataFrame:
        by_doc = hits.select(F.col("doc_id").alias(hit_id), F.col("rid").alias(hit_rid), F.col("hashes").alias(name))
        on = (F.col(rid) == F.col(hit_rid)) & F.col("doc_id").cast("long").eqNullSafe(F.col(hit_id))
        # The hits are hashed, so texts aren't sorted for the join.
        return left.join(by_doc.hint("shuffle_hash"), on, "left").drop(hit_id, hit_rid)

    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col(rid).alias("rid"), F.coalesce(text, F.lit("")).alias("text")]
    anchored = joined(rows, met(rows.select(*own).mapInArrow(_send_blocks(window, buckets), _PACKED), True), anchors)
    found = met(anchored.select(*own, F.col(anchors).alias("anchors")).mapInArrow(_send_windows(window, buckets), _PACKED), False)
    kinds = [T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType, True) for f in docs.schema]
    kinds += [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    schema = T.StructType(kinds)
    return joined(anchored, found, repeats).mapInArrow(_finish(window, buckets, schema.names, (text, anchors, repeats)), schema)


def op2_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_substrings(load(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = f"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM t),
g AS (
  SELECT doc_id, i, string_agg(w, ' ') OVER s AS words, count(*) OVER s AS n FROM w
  WINDOW s AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING)
),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY words) AS times FROM g WHERE n = {WINDOW}),
gone AS (SELECT DISTINCT doc_id, i + unnest(range({WINDOW})) AS i FROM r WHERE times > 1)
SELECT d.doc_id, count(w.i) AS n_words, count(gone.i) AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN gone.i IS NULL THEN w.w END, ' ' ORDER BY w.i), '')) AS kept_sha256
FROM documents d LEFT JOIN w ON d.doc_id = w.doc_id LEFT JOIN gone ON w.doc_id = gone.doc_id AND w.i = gone.i
GROUP BY d.doc_id
"""
