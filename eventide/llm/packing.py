"""Packing: vector bin packing by the dot-product heuristic.

A sequence is a bin with three limits: tokens, segments and loss-bearing
tokens. A piece of a document is a vector of its three sizes. Whole sequences
are cut off long documents first. What is left waits; the open sequence takes
the waiting piece that fits and has the greatest dot product of its sizes with
the room left, each dimension divided by its limit. Where none fits, the piece
with the most tokens is cut so that the room is filled.

Pieces of equal vectors wait in one queue, so a choice looks at different
vectors only, however many pieces wait. ``POOL`` counts waiting ids, not
pieces: short documents fill sequences as well as long ones.

Each task packs the rows of its own partition, so nothing is shuffled and
only the last sequence of a partition may have room left. Sequence ids are
the partition's number and a count; a task that runs again gives the same.

* A null text counts as an empty text: the end id alone. An empty table has
  no sequences.
* Very long texts are tokenized in stretches and cut into whole sequences;
  what waits of them is less than a sequence.
* Rows are packed by themselves: rows that repeat are packed as often. Of
  pieces that are worth the same, the one that has waited longest goes first.
* ``loss_from``, where given, names a column with the number of leading ids
  that bear no loss (a prompt); null counts as 0.
* Columns beside those aren't read, so clashing names don't matter.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm import word_bpe
from eventide.llm.byte_bpe import slices
from eventide.llm.common import load

#: The limit of segments is as high as that of tokens, so documents of one id fill sequences too; training with fewer sets a lower one.
MAX_TOKENS, MAX_SEGMENTS = 2048, 2048
#: Sequences' worth of ids that wait before one is filled; bounds a task's memory.
POOL = 64


@dataclass
class Piece:
    doc: int | None
    ids: bytes | memoryview
    start: int
    n: int
    free: int  # leading ids of the document that bear no loss
    total: int

    def loss(self, n: int | None = None) -> int:
        return max(0, self.start + (self.n if n is None else n) - max(self.start, self.free))

    def within(self, tokens: int, loss: int) -> int:
        """The most ids from the piece's start that keep to both limits."""
        return min(self.n, tokens, max(0, self.free - self.start) + loss)


@dataclass
class Packer:
    max_tokens: int = MAX_TOKENS
    max_segments: int = MAX_SEGMENTS
    max_loss: int = MAX_TOKENS
    base: int = 0
    sequence: int = 0
    #: Waiting pieces by their vector: (tokens, loss-bearing tokens).
    pool: dict[tuple[int, int], deque[Piece]] = field(default_factory=dict)
    waiting: int = 0

    def add(self, piece: Piece):
        """Takes a document; yields (piece, sequence, offset) as sequences fill up."""
        while (k := piece.within(self.max_tokens, self.max_loss)) < piece.n or k == self.max_tokens:
            if k < self.max_tokens:  # the loss limit cuts it: it waits for others that bear no loss
                self._wait(self._head(piece, k))
            else:
                yield self._head(piece, k), self.base + self.sequence, 0
                self.sequence += 1
            if not piece.n:
                return
        self._wait(piece)
        while self.waiting > POOL * self.max_tokens:
            yield from self._fill()

    def finish(self):
        while self.waiting:
            yield from self._fill()

    @staticmethod
    def _head(piece: Piece, k: int) -> Piece:
        """Cut k ids off the front."""
        head = Piece(piece.doc, piece.ids[: 4 * k], piece.start, k, piece.free, piece.total)
        piece.ids, piece.start, piece.n = piece.ids[4 * k :], piece.start + k, piece.n - k
        return head

    def _wait(self, piece: Piece, first: bool = False) -> None:
        piece.ids = bytes(piece.ids)  # its own copy, not a view that holds the whole document
        queue = self.pool.setdefault((piece.n, piece.loss()), deque())
        (queue.appendleft if first else queue.append)(piece)
        self.waiting += piece.n

    def _take(self, vector: tuple[int, int]) -> Piece:
        queue = self.pool[vector]
        piece = queue.popleft()
        if not queue:
            del self.pool[vector]
        self.waiting -= piece.n
        return piece

    def _fill(self):
        """Fill one sequence from what waits."""
        tokens, segments, bearing, offset = self.max_tokens, self.max_segments, self.max_loss, 0
        vectors = list(self.pool)
        n, loss = np.array(vectors, np.int64).T.copy()
        left = np.array([len(self.pool[v]) for v in vectors])
        while tokens and segments and self.waiting:
            fits = (left > 0) & (n <= tokens) & (loss <= bearing)
            if fits.any():
                # The dot product with the room left; every piece adds the same for its one segment.
                value = n * (tokens / self.max_tokens**2) + loss * (bearing / self.max_loss**2) + segments / self.max_segments**2
                at = int(np.where(fits, value, -1.0).argmax())
                piece = self._take(vectors[at])
                left[at] -= 1
            else:
                # None fits whole: ids that bear no loss lead a piece, so at least so many of it fit.
                room = np.where(left > 0, np.minimum(tokens, n - loss + bearing), 0)
                if not room.max():
                    break
                at = int(np.where(room == room.max(), n, -1).argmax())
                whole = self._take(vectors[at])
                left[at] -= 1
                piece = self._head(whole, min(int(room[at]), whole.n))
                self._wait(whole, first=True)
                key = (whole.n, whole.loss())
                if key in vectors:
                    left[vectors.index(key)] += 1
                else:
                    vectors.append(key)
                    n, loss, left = np.append(n, key[0]), np.append(loss, key[1]), np.append(left, 1)
            yield piece, self.base + self.sequence, offset
            offset += piece.n
            tokens, segments, bearing = tokens - piece.n, segments - 1, bearing - piece.loss()
        self.sequence += 1


_OUT = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]


def _pack(path: str, end_id: int, limits: tuple[int, int, int]):
    end = np.array([end_id], "<u4").tobytes()

    def batch_of(placed):
        rows = [(p.doc, p.start, p.n, bytes(p.ids), p.total, s, o) for p, s, o in placed]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(_OUT)], names=[n for n, _ in _OUT])

    def run(batches):
        bpe = word_bpe.loaded(path)
        packer = Packer(*limits, base=TaskContext.get().partitionId() << 40)
        for batch in batches:
            keys, texts, frees = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()], batch.column(2).to_pylist()
            for a, z in slices(texts):
                placed = []
                for key, ids, free in zip(keys[a:z], bpe.encode_batch(texts[a:z]), frees[a:z], strict=True):
                    n = len(ids) // 4 + 1
                    placed += packer.add(Piece(key, memoryview(ids + end), 0, n, min(max(free or 0, 0), n), n))
                yield batch_of(placed)
        yield batch_of(packer.finish())

    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, max_tokens: int = MAX_TOKENS, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_TOKENS, loss_from: str | None = None) -> DataFrame:
    """A row for each piece: doc_id, start (its document's ids before it), length, ids, doc_tokens, sequence_id, offset."""
    if min(max_tokens, max_segments, max_loss) < 1:
        raise ValueError("limits must be 1 or more")
    free = F.col(loss_from).cast("long") if loss_from else F.lit(0).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), free.alias("free"))
    return rows.mapInArrow(_pack(tokenizer, end_id, (max_tokens, max_segments, max_loss)), "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def op5_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    out = pack(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)
    return out.select("doc_id", "start", "length", word_bpe.ids_crc32().alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
