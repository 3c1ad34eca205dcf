"""Nearest neighbours by a forest of hash prefixes.

Every tree is a sorted array of 64-bit strings, a bit for each side of a random
plane. Vectors with a long common prefix lie side by side in it, so a query
descends to its longest match by binary search, and ascends by giving up the
last bits of the prefix: by the same number in all trees at once, until the
trees together hold ``ENOUGH`` candidates. All of these are compared exactly.

For the inner product to be an angle, a vector gets one more component that
brings it to the length of the longest; a query gets 0 there.

Equal vectors are one entry of the forest with their ``k + 1`` lowest ids: as they
have equal scores, no other of their ids can be among a query's ``k`` nearest.
Equal queries are searched once.

A tree is cut into pieces of about ``PIECE`` entries by a sample of ``SAMPLE``
entries, and a query is read in the piece that it falls into and the two beside
it. Each (tree, piece) is a group of its own: first, the entries for each length
of prefix are counted; then the length is chosen from the counts of all trees;
then entries are compared. Vectors that share a string are dealt into as many
pieces as the sample has of it, so no piece grows with a group of near copies.
Pieces, candidates of a query and so the work for a query don't grow with the
table; how many near ones are found for it falls slowly.

* Vectors that are null, empty, all zero, or hold a null or non-finite component
  take no part. Vectors of another length than the query's aren't candidates.
  An empty table gives an empty result.
* Rows that repeat are candidates each; a query's own row is left out once.
  Equal scores go by vec_id, null lowest; a row without vec_id asks nothing.
* Very long vectors are hashed ``AT_ONCE`` components at a time.
* Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import load, salted_join, shared_path

#: Neighbours of a query; rows whose id this divides are the queries.
NEAREST, EVERY = 20, 20
#: Trees; candidates, counted in each tree, that are enough; entries of a piece; sampled entries; seed of the planes.
TREES, ENOUGH, PIECE, SAMPLE, SEED = 16, 48_000, 8192, 16_384, 12
#: Components that are hashed at once, and products that are held at once.
AT_ONCE, PRODUCTS = 1 << 17, 1 << 21
WIDTH = 64


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and x (float or double components) of the vectors that take part, with the 128-bit key k1, k2 of x."""
    kind = vectors.schema["embedding"].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    component = "float" if single else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{component}>").alias("x"))
    finite = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    rows = rows.where(F.col("x").isNotNull() & finite & F.exists("x", lambda e: e != 0))
    # -0 becomes 0, so equal vectors have equal keys.
    rows = rows.withColumn("x", F.transform("x", lambda e: e + F.lit(0).cast(component)))
    return rows.withColumns({"k1": F.xxhash64("x"), "k2": F.xxhash64(F.lit(1), "x")})


def entries(rows: DataFrame, k: int) -> DataFrame:
    """k1, k2, x and the k + 1 lowest ids of each different vector."""
    nth = F.row_number().over(Window.partitionBy("k1", "k2", "x").orderBy(F.asc_nulls_first("vec_id")))
    low = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    ids = F.transform(F.array_sort(F.collect_list(F.struct("nth", "vec_id"))), lambda s: s["vec_id"])
    return low.groupBy("k1", "k2", "x").agg(ids.alias("ids"))


def by_length(column: pa.Array):
    """Rows and their vectors as a matrix of doubles, for each length of vector in a column of lists."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths, values = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        yield n, rows, values[begins[rows][:, None] + np.arange(n)].astype(np.float64)


class Strings:
    """Hash strings of vectors, made by the same planes everywhere."""

    def __init__(self, longest: float):
        self.longest, self.planes = longest, {}

    def of(self, x: np.ndarray, asks: bool) -> np.ndarray:
        """A row of strings for each vector, one for each tree."""
        n = x.shape[1]
        if n not in self.planes:
            self.planes = {n: np.random.default_rng([SEED, n]).standard_normal((n + 1, TREES * WIDTH), np.float32)}
        planes, out = self.planes[n], np.empty((len(x), TREES), np.uint64)
        step = max(1, AT_ONCE // max(n, TREES * WIDTH))
        for a in range(0, len(x), step):
            own = x[a : a + step] / self.longest
            side = own @ planes[:n]
            if not asks:
                side += np.sqrt(np.maximum(0, 1 - (own * own).sum(axis=1)))[:, None] * planes[n]
            out[a : a + step] = np.packbits(side > 0, axis=1).view(">u8")
        return out


class Pieces:
    """Which piece of a tree a string falls into."""

    def __init__(self, total: int, lengths: np.ndarray, strings: np.ndarray):
        self.cut = {}
        for n in np.unique(lengths).tolist():
            own = np.sort(strings[lengths == n], axis=0)
            ends = np.zeros((1, TREES), np.uint64)
            self.cut[n] = (np.concatenate([ends, own, ~ends]), max(1, math.ceil(total * len(own) / len(lengths) / PIECE)))

    def of(self, n: int, tree: int, h: np.ndarray, share: np.ndarray | float) -> np.ndarray:
        """Pieces of strings; ``share`` (0 to 1) deals those that the sample has repeatedly over the pieces they reach."""
        if n not in self.cut:
            return np.zeros(len(h), np.int64)
        samples, pieces = self.cut[n]
        samples = samples[:, tree]
        left, right = np.searchsorted(samples, h, "left"), np.searchsorted(samples, h, "right")
        low, high = samples[np.maximum(left - 1, 0)].astype(np.float64), samples[np.minimum(left, len(samples) - 1)].astype(np.float64)
        between = left - 1 + (h.astype(np.float64) - low) / np.maximum(high - low, 1)
        at = np.where(right > left, left + share * (right - 1 - left), between)
        return np.clip(at / (len(samples) - 1) * pieces, 0, pieces - 1).astype(np.int64)

    def last(self, n: int) -> int:
        return self.cut[n][1] - 1 if n in self.cut else 0


def below(h: np.ndarray, level: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """First and last string that share ``level`` bits with h."""
    level = np.broadcast_to(np.asarray(level, np.uint64), h.shape)
    rest = np.where(level >= WIDTH, np.uint64(0), ~np.uint64(0) >> np.minimum(level, np.uint64(WIDTH - 1)))
    return h & ~rest, h | rest


def _share(k1: np.ndarray) -> np.ndarray:
    return k1.astype(np.uint64).astype(np.float64) / 2.0**64


def _take(batch: pa.RecordBatch, names: list[str], rows: np.ndarray, **made: np.ndarray) -> pa.RecordBatch:
    kept = batch.select(names).take(pa.array(rows))
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in made.values()), *kept.columns], names=[*made, *names])


def deal_entries(forest: DataFrame, pieces, names: list[str]) -> DataFrame:
    """A row for each entry and tree, with its piece; ``names`` are the entry's columns that go along."""

    def run(batches):
        cut = pieces.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            share = _share(batch.column("k1").to_numpy())
            strings = batch.column("strings").flatten().to_numpy().view(np.uint64).reshape(-1, TREES)
            for n in np.unique(lengths).tolist():
                rows = np.flatnonzero(lengths == n)
                for t in range(TREES):
                    h = strings[rows, t]
                    yield _take(batch, names, rows, length=np.full(len(rows), n), tree=np.full(len(rows), t), piece=cut.of(n, t, h, share[rows]), string=h.view(np.int64))

    carried = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in forest.select(names).schema)
    needed = list(dict.fromkeys(["length", "k1", "strings", *names]))
    return forest.select(needed).mapInArrow(run, "length long, tree long, piece long, string long" + (", " + carried if carried else ""))


def deal_queries(queries: DataFrame, pieces, longest: float, names: list[str]) -> DataFrame:
    """A row for each query, tree and piece it is read in; with a column level, only pieces that its prefix reaches."""
    levels = "level" in queries.columns

    def run(batches):
        cut, strings = pieces.value, Strings(longest)
        for batch in batches:
            share = _share(batch.column("q1").to_numpy())
            level = batch.column("level").to_numpy() if levels else None
            for n, rows, x in by_length(batch.column("q")):
                hashed = strings.of(x, True)
                for t in range(TREES):
                    h = hashed[:, t]
                    own = cut.of(n, t, h, share[rows])
                    low, high = np.maximum(own - 1, 0), np.minimum(own + 1, cut.last(n))
                    if levels:
                        first, last = below(h, level[rows])
                        low, high = np.maximum(low, cut.of(n, t, first, 0.0)), np.minimum(high, cut.of(n, t, last, 1.0))
                    for step in range(3):
                        at = np.flatnonzero(low + step <= high)
                        yield _take(batch, names, rows[at], length=np.full(len(at), n), tree=np.full(len(at), t), piece=low[at] + step, string=h[at].view(np.int64))

    carried = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.select(names).schema)
    return queries.mapInArrow(run, f"length long, tree long, piece long, string long, {carried}")


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def count_levels(entries_: pa.Table, queries: pa.Table) -> pa.Table:
    """q1, q2, level and n: entries of a piece that share exactly ``level`` bits with a query, up to where they are enough."""
    names = ["q1", "q2", "level", "n"]
    held, asked = np.sort(_column(entries_, "string").view(np.uint64)), _column(queries, "string").view(np.uint64)
    out, before = [], np.zeros(len(asked), np.int64)
    for level in range(WIDTH, -1, -1):
        first, last = below(asked, level)
        now = np.searchsorted(held, last, "right") - np.searchsorted(held, first, "left")
        at = np.flatnonzero((now > before) & (before < ENOUGH))
        if len(at):
            out.append((at, np.full(len(at), level), (now - before)[at]))
        before = now
    at, level, n = (np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)) if out else [np.empty(0, np.int64)] * 3
    return pa.Table.from_arrays([pa.array(_column(queries, c)[at]) for c in names[:2]] + [pa.array(level), pa.array(n)], names=names)


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of rows of x with q, each summed by itself, so that equal rows give the same bits wherever they stand."""
    return (x * q).sum(axis=1)


def nearest_in_piece(entries_: pa.Table, queries: pa.Table, most: int) -> pa.Table:
    """q1, q2, k1, k2, ids and score of the ``most`` nearest entries of a piece that share a query's prefix."""
    order = np.argsort(_column(entries_, "string").view(np.uint64), kind="stable")
    held = _column(entries_, "string").view(np.uint64)[order]
    x = next(by_length(entries_.column("x")), (0, [], np.empty((0, 1))))[2][order]
    lowest = entries_.column("lowest").combine_chunks().fill_null(int(np.iinfo(np.int64).min)).to_numpy(zero_copy_only=False)[order]
    q = next(by_length(queries.column("q")), (0, [], np.empty((0, 1))))[2]
    first, last = below(_column(queries, "string").view(np.uint64), _column(queries, "level"))
    a, b = np.searchsorted(held, first, "left"), np.searchsorted(held, last, "right")
    lengths = np.sqrt((x * x).sum(axis=1)).max(initial=0) * np.sqrt((q * q).sum(axis=1))
    asker, found, scores = [], [], []
    for span in np.unique(np.stack([a, b]), axis=1).T.tolist():
        if span[0] == span[1]:
            continue
        own, part = np.flatnonzero((a == span[0]) & (b == span[1])), x[span[0] : span[1]]
        step = max(1, PRODUCTS // len(part))
        for s in range(0, len(own), step):
            block = own[s : s + step]
            for i, near in zip(block.tolist(), q[block] @ part.T, strict=True):
                if len(near) > most:
                    # A block's products may differ in the last bits: what comes near the border is looked at again.
                    border = near[np.argpartition(near, len(near) - most)[len(near) - most]]
                    at = np.flatnonzero(near >= border - 1e-9 * lengths[i])
                else:
                    at = np.arange(len(near))
                score = products(part[at], q[i])
                best = np.lexsort((lowest[span[0] + at], -score))[:most]
                asker.append(np.full(len(best), i))
                found.append(span[0] + at[best])
                scores.append(score[best])
    asker, found = (np.concatenate(c) if c else np.empty(0, np.int64) for c in (asker, found))
    taken = entries_.select(["k1", "k2", "ids"]).take(pa.array(order[found]))
    mine = queries.select(["q1", "q2"]).take(pa.array(asker))
    return pa.Table.from_arrays([*mine.columns, *taken.columns, pa.array(np.concatenate(scores) if scores else np.empty(0))], names=["q1", "q2", "k1", "k2", "ids", "score"])


def neighbours(vectors: DataFrame, asks, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest rows found for each row for which ``asks``, a condition on vec_id, holds."""
    spark, rows = vectors.sparkSession, usable(vectors)
    square = F.aggregate("x", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    longest = rows.agg(F.max(square)).first()[0]
    if longest is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = math.sqrt(longest)

    def hashed(batches):
        strings = Strings(longest)
        for batch in batches:
            out = np.empty((batch.num_rows, TREES), np.uint64)
            for _, at, x in by_length(batch.column("x")):
                out[at] = strings.of(x, False)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, out.size + 1, TREES, np.int32)), pa.array(out.view(np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "strings"])

    # The forest: every entry with its strings, written once.
    found = entries(rows, k).withColumns({"length": F.size("x").cast("long"), "lowest": F.col("ids")[0]})
    path = shared_path(spark, "forest")
    found.mapInArrow(hashed, T.StructType([*found.schema.fields, T.StructField("strings", T.ArrayType(T.LongType()))])).write.parquet(path)
    forest = spark.read.parquet(path)
    sample = forest.orderBy(F.xxhash64("k2"), "k1").limit(SAMPLE).select("length", "strings").toArrow()
    cut = Pieces(forest.count(), _column(sample, "length"), sample.column("strings").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, TREES))
    pieces = spark.sparkContext.broadcast(cut)  # SAMPLE strings a tree

    asked = rows.where(asks)
    queries = asked.groupBy("k1", "k2", "x").agg(F.count("*").alias("n")).select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("x").alias("q"), "n")
    asked_at = shared_path(spark, "asked")
    queries.write.parquet(asked_at)
    queries = spark.read.parquet(asked_at)

    at = ["length", "tree", "piece"]
    met = deal_entries(forest, pieces, []).groupBy(at).cogroup(deal_queries(queries.select("q1", "q2", "q"), pieces, longest, ["q1", "q2"]).groupBy(at))
    levels = met.applyInArrow(count_levels, "q1 long, q2 long, level long, n long").groupBy("q1", "q2", "level").agg(F.sum("n").alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("q1", "q2").orderBy(F.desc("level")))
    enough = levels.withColumn("n", so_far).where(F.col("n") >= ENOUGH).groupBy("q1", "q2").agg(F.max("level").alias("level"))
    # All of what is in reach, where that isn't enough.
    leveled = queries.select("q1", "q2", "q").join(enough, ["q1", "q2"], "left").withColumn("level", F.coalesce("level", F.lit(0).cast("long")))

    met = deal_entries(forest, pieces, ["k1", "k2", "x", "ids", "lowest"]).groupBy(at).cogroup(deal_queries(leveled, pieces, longest, ["q1", "q2", "q", "level"]).groupBy(at))
    near = met.applyInArrow(lambda e, q: nearest_in_piece(e, q, k + 1), "q1 long, q2 long, k1 long, k2 long, ids array<long>, score double")
    # An entry that several trees have found counts once.
    near = near.repartition("q1", "q2").groupBy("q1", "q2", "k1", "k2").agg(F.first("score").alias("score"), F.first("ids").alias("ids"))
    near = near.select("q1", "q2", "k1", "k2", "score", "ids", F.posexplode("ids").alias("nth", "vec_id"))
    near = near.withColumn("first", (F.col("nth") == 0) | ~F.col("vec_id").eqNullSafe(F.get("ids", F.col("nth") - 1))).drop("ids")
    rank = F.row_number().over(Window.partitionBy("q1", "q2").orderBy(F.desc("score"), F.asc_nulls_first("vec_id"), "k1", "k2", "nth"))
    near = near.withColumn("rank", rank).where(F.col("rank") <= k + 1)
    lists = near.groupBy(F.struct(F.col("q1").alias("k1"), F.col("q2").alias("k2")).alias("entry")).agg(F.array_sort(F.collect_list(F.struct("rank", "k1", "k2", "vec_id", "first", "score"))).alias("near"))

    # Each of the equal queries leaves its own row out, once.
    askers = asked.select(F.col("vec_id").alias("query_id"), F.struct("k1", "k2").alias("entry"))
    out = salted_join(askers, lists, "entry", "inner", ["query_id"], counts=queries.select(F.struct(F.col("q1").alias("k1"), F.col("q2").alias("k2")).alias("entry"), "n"))
    own = lambda e: e["first"] & (e["k1"] == F.col("entry.k1")) & (e["k2"] == F.col("entry.k2")) & e["vec_id"].eqNullSafe(F.col("query_id"))
    out = out.select("query_id", F.posexplode(F.slice(F.filter("near", lambda e: ~own(e)), 1, k)).alias("nth", "e"))
    return out.select("query_id", (F.col("nth") + 1).cast("int").alias("rank"), F.col("e.vec_id").alias("vec_id"), F.col("e.score").alias("score"))


def op12_neighbours(spark, sf_dir: str) -> DataFrame:
    return neighbours(load(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % EVERY == 0)
