"""Byte-level BPE with the ranks of a tiktoken file, on padded numpy matrices.

A text is cut by the vocabulary's pattern; each piece is encoded by itself.
Distinct pieces are put into buckets by length and become the rows of a padded
matrix of ids. In every round each row merges its leftmost pair of minimum
rank: pairs are looked up in an open-addressing hash table held in numpy
arrays, the merged place is closed up, and rows that have no pair left are
taken out. Only the two pairs beside a merge are looked up again.

Pieces of over ``WIDE`` bytes are first cut where two bytes stand together in
no token; what is still longer is a row by itself, so that no matrix is padded
to its width, and merges all places of its minimum-rank pair in one round.
Where such a merge makes a pair of a lower rank, the round has one merge only.

Encoded stretches of text are kept in a bounded table in each worker. A
stretch ends at a single space between two other characters: there no piece
goes across, and the space belongs to what follows. Very long texts are cut
into chunks there too.

* A null text counts as an empty text: no ids.
* Special tokens do not exist here; their strings are ordinary text.
* Rows are independent of each other: repeated rows get equal results.
* An empty table gives an empty result.
* Columns beside doc_id and text aren't read, so clashing names don't matter.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import Known, load, mix64

#: Bytes of a row above which it is merged by itself.
WIDE = 256
#: Cells of a matrix; with CHUNK, the characters cut together, it bounds a worker's memory.
CELLS, CHUNK = 1 << 19, 1 << 20
#: Characters of text that are looked at together.
SLICE = 2_000_000
_NONE = np.int32(0x7FFFFFFF)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class PairTable:
    """Rank by pair of ids; open addressing with linear probing."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        bits = max(4, int(len(keys) * 2.5).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, _EMPTY)
        self.ranks = np.full(1 << bits, _NONE)
        slot = mix64(keys) & self.mask
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[slot[left]] == _EMPTY
            self.keys[slot[left[free]]] = keys[left[free]]
            placed = self.keys[slot[left]] == keys[left]
            self.ranks[slot[left[placed]]] = ranks[left[placed]]
            left = left[~placed]
            slot[left] = (slot[left] + np.uint64(1)) & self.mask

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs, _NONE where there is none; ids below zero pair with nothing."""
        out = np.full(a.shape, _NONE)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        keys = (a.ravel()[at].astype(np.uint64) << np.uint64(32)) | b.ravel()[at].astype(np.uint64)
        slot = mix64(keys) & self.mask
        flat = out.ravel()
        while len(at):
            there = self.keys[slot]
            hit = there == keys
            flat[at[hit]] = self.ranks[slot[hit]]
            more = ~hit & (there != _EMPTY)
            at, keys, slot = at[more], keys[more], (slot[more] + np.uint64(1)) & self.mask
        return flat.reshape(a.shape)


class ByteBPE:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        pairs, merged = [], []
        for token, rank in ranks.items():
            self.tokens[rank] = token
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs.append(a << 32 | b)
                    merged.append(rank)
        self.table = PairTable(np.array(pairs, np.uint64), np.array(merged, np.int32))
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.pattern = regex.compile(pattern)
        self.runs = regex.compile(r" \s|\s ")
        self.between = re.compile(r"(?<=\S)(?= \S)")
        self.pieces, self.stretches = Known(), Known()
        self.together = np.zeros((256, 256), bool)
        for token in self.tokens:
            self.together[list(token[:-1]), list(token[1:])] = True

    def _matrix(self, mat: np.ndarray) -> list[np.ndarray]:
        """Ids of each row of a matrix that is padded with -1."""
        out: list[np.ndarray | None] = [None] * len(mat)
        rows = np.arange(len(mat))
        rank = self.table.look_up(mat[:, :-1], mat[:, 1:])
        while True:
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(mat), np.int64)
            low = rank[np.arange(len(mat)), at] if rank.shape[1] else np.full(len(mat), _NONE)
            for i in np.flatnonzero(low == _NONE):
                out[rows[i]] = mat[i][mat[i] >= 0]
            going = low != _NONE
            if not going.any():
                return out
            mat, rank, rows, at, low = mat[going], rank[going], rows[going], at[going], low[going]
            n, width = mat.shape
            each, columns = np.arange(n), np.arange(width - 1)
            # The right half of the pair goes, what stands behind it moves up.
            mat = np.take_along_axis(mat, columns + (columns > at[:, None]), axis=1)
            mat[each, at] = low
            columns = np.arange(width - 2)
            rank = np.take_along_axis(rank, columns + (columns >= at[:, None]), axis=1)
            before = np.flatnonzero(at > 0)
            rank[before, at[before] - 1] = self.table.look_up(mat[before, at[before] - 1], mat[before, at[before]])
            after = np.flatnonzero(at < width - 2)
            rank[after, at[after]] = self.table.look_up(mat[after, at[after]], mat[after, at[after] + 1])

    def _long(self, ids: np.ndarray) -> np.ndarray:
        """Ids of one long row. Every place of its minimum-rank pair merges in a round, from the left, unless that makes a pair of a lower rank."""
        rank = self.table.look_up(ids[:-1], ids[1:])
        while len(rank) and (low := rank.min()) != _NONE:
            at = np.flatnonzero(rank == low)
            # Of pairs that overlap (all of one id), every other one.
            runs = np.flatnonzero(np.append(True, np.diff(at) > 1))
            at = at[(np.arange(len(at)) - np.repeat(runs, np.diff(np.append(runs, len(at))))) % 2 == 0]
            behind = at[at + 2 < len(ids)] + 2
            if (self.table.look_up(np.full(len(behind), low), ids[behind]) < low).any():
                at = at[:1]
            merged = self._closed_up(ids, rank, at, low)
            if len(at) > 1 and merged[2] < low:
                merged = self._closed_up(ids, rank, at[:1], low)
            ids, rank, _ = merged
        return ids

    def _closed_up(self, ids: np.ndarray, rank: np.ndarray, at: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and ranks with the pairs at ``at`` merged, and the lowest of the new ranks."""
        stays = np.ones(len(ids), bool)
        stays[at + 1] = False
        ids = ids.copy()
        ids[at] = low
        ids, rank = ids[stays], rank[stays[1:]].copy()
        now = at - np.arange(len(at))
        beside = np.concatenate([now[now > 0] - 1, now[now < len(rank)]])
        rank[beside] = new = self.table.look_up(ids[beside], ids[beside + 1])
        return ids, rank, int(new.min()) if len(new) else int(_NONE)

    def _rows(self, raw: bytes) -> list[bytes]:
        """A piece cut where the two bytes stand together in no token: no merge goes across."""
        b = np.frombuffer(raw, np.uint8)
        ends = (np.flatnonzero(~self.together[b[:-1], b[1:]]) + 1).tolist()
        return [raw[i:j] for i, j in zip([0, *ends], [*ends, len(raw)], strict=True)]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces, as little-endian unsigned 32-bit integers."""
        raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
        own = [self._rows(p) if len(p) > WIDE else [p] for p in raw]
        raw = [r for rows in own for r in rows]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        out: list[bytes] = [b""] * len(raw)
        bucket = np.where(sizes > WIDE, -1, np.ceil(np.log2(np.maximum(sizes, 2))).astype(np.int64))
        for i in np.flatnonzero(bucket < 0):
            out[i] = self._long(self.single[np.frombuffer(raw[i], np.uint8)]).astype("<u4").tobytes()
        for b in np.unique(bucket[bucket >= 0]):
            rows = np.flatnonzero(bucket == b)
            for part in np.array_split(rows, -(-len(rows) * (1 << int(b)) // CELLS)):
                width = int(sizes[part].max())
                mat = np.full((len(part), width), -1, np.int32)
                inside = np.arange(width) < sizes[part][:, None]
                mat[inside] = self.single[np.frombuffer(b"".join(raw[i] for i in part), np.uint8)]
                for i, ids in zip(part, self._matrix(mat), strict=True):
                    out[i] = ids.astype("<u4").tobytes()
        ends = np.cumsum([0, *map(len, own)]).tolist()
        return [out[i] if j == i + 1 else b"".join(out[i:j]) for i, j in zip(ends, ends[1:], strict=False)]

    def _cut(self, text: str) -> list[str]:
        """Stretches of the text; no piece goes across their ends."""
        if self.runs.search(text) or text[:1] == " " or text[-1:] == " ":
            return self.between.split(text)
        words = text.split(" ")
        return words[:1] + [" " + x for x in words[1:]]

    def _chunks(self, text: str):
        """The text in parts of about ``CHUNK`` characters that end where stretches do."""
        a = 0
        while len(text) - a > CHUNK:
            m = self.between.search(text, a + CHUNK)
            if not m:
                break
            yield text[a : m.start()]
            a = m.start()
        yield text[a:] if a else text

    def _learn(self, parts: list[list[str]]) -> list[str]:
        """Put all stretches into the table; those to be dropped again afterwards."""
        new = self.stretches.enter(set().union(*parts))
        found = [self.pattern.findall(m) for m in new]
        pieces = self.pieces.enter({p for ps in found for p in ps})
        self.pieces.update(zip(pieces, self.encode_pieces(pieces), strict=True))
        self.stretches.update((m, b"".join(map(self.pieces.__getitem__, ps))) for m, ps in zip(new, found, strict=True))
        self.pieces.leave(pieces)
        return new

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, as little-endian unsigned 32-bit integers."""
        made: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []

        def flush():
            new = self._learn([p for _, p in waiting])
            for i, p in waiting:
                made[i].append(b"".join(map(self.stretches.__getitem__, p)))
            self.stretches.leave(new)
            waiting.clear()

        n = 0
        for i, text in enumerate(texts):
            for chunk in self._chunks(text):
                waiting.append((i, self._cut(chunk)))
                n += len(chunk)
                if n >= CHUNK:
                    flush()
                    n = 0
        flush()
        return [m[0] if len(m) == 1 else b"".join(m) for m in made]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_LOADED: dict[tuple[str, str], ByteBPE] = {}


def loaded(path: str, pattern: str) -> ByteBPE:
    """One for each worker."""
    if (path, pattern) not in _LOADED:
        _LOADED[path, pattern] = ByteBPE(path, pattern)
    return _LOADED[path, pattern]


def slices(texts: list[str], most: int = SLICE):
    """Index ranges of texts with about so many characters each."""
    a = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= most:
            yield a, i + 1
            a, n = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _encode(path: str, pattern: str):
    def run(batches):
        bpe = loaded(path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, z in slices(texts):
                ids = bpe.encode_batch(texts[a:z])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, z - a), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return run


def _decode(path: str, pattern: str):
    def run(batches):
        bpe = loaded(path, pattern)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(map(bpe.decode, batch.column(1).to_pylist()), pa.binary())], names=["doc_id", "ids", "decoded"])

    return run


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) of each text."""
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(_encode(path, pattern), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """The rows of encode() with the decoded bytes."""
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path, pattern), f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, ids binary, decoded binary")


def op10_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    at = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    out = decode(encode(load(spark, sf_dir, "documents"), *at), *at)
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
