"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked within a Hamming radius through BK-trees.

ASCII letters are lower-cased; words are ``[^\\x20\\x09-\\x0D]+``; every shingle
of three words, repeats included, is hashed with XXH64 (seed 42). A bit of the
fingerprint is set if it is set in over half of the hashes.

Fingerprints differing in at most ``RADIUS`` bits are linked. Equal ones are
joined up first. The 64 bits are cut into four blocks; two fingerprints within
the radius agree on two blocks at least, so each goes to the six shards that
its pairs of blocks name. A shard builds a BK-tree, whose children are keyed
by their Hamming distance to the parent, and follows only edges within the
radius. The trees stand where the shard's fingerprints are dealt to instead of
being broadcast, as they grow with the corpus. A shard of over ``SHARD``
fingerprints is dealt anew by thirds of its other 32 bits, of which one third
must agree: no tree then has over 2**22 nodes, whatever the data. A shard
reports a spanning set of links, not all pairs; no link between different
fingerprints loses its component.

* A null or empty text has fingerprint zero and is linked like any other. An
  empty table gives an empty result.
* Very long texts are hashed whole, in their row.
* Texts of one or two words have one shingle: all their words.
* Rows that repeat a doc_id get a row each; a component's id is null only if
  all its doc_ids are.
* Columns beside doc_id and text aren't read; :func:`keep_first` keeps them,
  and names used inside yield to theirs. Ties: the lowest doc_id and row key.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import load, remove_path, row_key, salted_join, shared_path, spare

SHINGLE, SEED, RADIUS = 3, 42, 2
#: Fingerprints in a shard from which it is dealt anew.
SHARD = 20_000


def shingle_hashes(text: str, shingle: int = SHINGLE) -> np.ndarray:
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(joined, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: -shingle + 1].tolist()
    return np.array([digest(joined[a:z], SEED) for a, z in zip(starts, ends[shingle - 1 :].tolist(), strict=True)], np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """The fingerprint, as a signed 64-bit integer."""
    if not len(hashes):
        return 0
    # Eight 8-bit counters to a lane; 255 rows can't overflow one.
    lanes = np.unpackbits(hashes.astype("<u8").view(np.uint8)).view(np.uint64).reshape(-1, 8)
    sums = np.add.reduceat(lanes, np.arange(0, len(lanes), 255), axis=0)
    counts = sums.view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes)).view("<i8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [simhash(shingle_hashes(t)) if t else 0 for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints, pa.int64())], names=["key", "rid", "print"])


class BKTree:
    """Children are keyed by their Hamming distance to the parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int, radius: int) -> list[int]:
        """The nodes within the radius."""
        found, open_ = [], [0] if self.values else []
        while open_:
            node = open_.pop()
            d = (self.values[node] ^ value).bit_count()
            if d <= radius:
                found.append(node)
            for edge, child in self.children[node].items():
                if -radius <= edge - d <= radius:
                    open_.append(child)
        return found

    def add(self, value: int) -> int:
        self.values.append(value)
        self.children.append({})
        new, node = len(self.values) - 1, 0
        while new:
            d = (self.values[node] ^ value).bit_count()
            child = self.children[node].get(d)
            if child is None:
                self.children[node][d] = new
                break
            node = child
        return new


class BKForest:
    """BK-trees of many groups at once, as arrays: the same trees as :class:`BKTree` makes of each group's distinct prints, lowest first."""

    #: More than any distance; (query, node) that a walk holds at once, but for a single query.
    EDGES, WALK = 128, 1 << 18

    def __init__(self, group: np.ndarray, prints: np.ndarray):
        """A print for each position, and the number of its group."""
        order = np.lexsort((prints, group))
        g, v = group[order], prints[order]
        new = np.ones(len(order), bool)
        new[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
        self.node, self.members, self.starts = np.empty(len(order), np.int64), order, np.append(np.flatnonzero(new), len(order))
        self.node[order] = np.cumsum(new) - 1
        self.values, g = v[new], g[new]
        first = np.ones(len(g), bool)
        first[1:] = g[1:] != g[:-1]
        self.root = np.flatnonzero(first)[np.cumsum(first) - 1]
        self.size = np.bincount(group)[group] if len(group) else group
        # All that wait at a node go down together: the first along each edge is its child, the others wait there.
        at, wait, keys, children = self.root.copy(), np.flatnonzero(~first), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(wait):
            d = np.bitwise_count(self.values[wait] ^ self.values[at[wait]]).astype(np.int64)
            key, one, back = np.unique(at[wait] * self.EDGES + d, return_index=True, return_inverse=True)
            keys.append(key)
            children.append(wait[one])
            at[wait] = wait[one][back]
            wait = np.delete(wait, one)
        keys, children = np.concatenate(keys), np.concatenate(children)
        order = np.argsort(keys)
        self.keys, self.children = keys[order], children[order]

    def _walk(self, asked: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        q, node, found = asked, self.root[self.node[asked]], []
        while len(q):
            d = np.bitwise_count(self.values[self.node[q]] ^ self.values[node]).astype(np.int64)
            found.append((q[d <= radius], node[d <= radius]))
            low = np.searchsorted(self.keys, node * self.EDGES + np.maximum(d - radius, 0))
            high = np.searchsorted(self.keys, node * self.EDGES + np.minimum(d + radius, self.EDGES - 1), side="right")
            q, node = np.repeat(q, high - low), self.children[spread(low, high)]
        q, node = (np.concatenate(x) for x in zip(*found, strict=True))
        low, high = self.starts[node], self.starts[node + 1]
        return np.repeat(q, high - low), self.members[spread(low, high)]

    def near(self, asked: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
        """For each of the ascending positions asked, those of its group within the radius, itself included."""
        ends = np.cumsum(self.size[asked])
        for part in np.split(asked, np.flatnonzero(np.diff(ends // self.WALK)) + 1):
            q, hits = self._walk(part, radius) if len(part) else (part, part)
            order = np.lexsort((hits, q))
            q, hits = q[order], hits[order]
            for at, low, high in zip(part.tolist(), np.searchsorted(q, part).tolist(), np.searchsorted(q, part, side="right").tolist(), strict=True):
                yield at, hits[low:high]


def spread(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The integers of all ranges, one range after another."""
    n = high - low
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())


def spanning_links(prints: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """(print, lowest print of its component) for distinct signed prints that are linked, without the lowest ones."""
    tree, parent = BKTree(), []

    def top(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    prints = sorted(prints)
    for p in prints:
        hits = tree.near(p & 0xFFFFFFFFFFFFFFFF, radius)
        parent.append(tree.add(p & 0xFFFFFFFFFFFFFFFF))
        for h in hits:
            a, z = sorted((top(h), top(len(parent) - 1)))
            parent[z] = a
    return [(p, prints[t]) for i, p in enumerate(prints) if (t := top(i)) != i]


def _search(radius: int):
    def run(batches):
        for batch in batches:
            links = [x for group in batch.column(0).to_pylist() for x in spanning_links(group, radius)]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])

    return run


def links(prints: DataFrame) -> DataFrame:
    """Spanning links (a > b) of a frame of distinct fingerprints ``print``."""
    block = [F.shiftrightunsigned("print", 48 - 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    pairs = list(combinations(range(4), 2))
    shard = F.array(*[F.struct(F.lit(c).alias("c"), (block[i] * 65536 + block[j]).alias("key")) for c, (i, j) in enumerate(pairs)])
    keyed = prints.select("print", F.explode(shard).alias("s")).select("print", "s.*")
    sizes = keyed.groupBy("c", "key").agg(F.count("*").alias("n")).where("n > 1")
    shared = keyed.join(sizes, ["c", "key"])
    rest = F.lit(None).cast("long")
    for c, (i, j) in enumerate(pairs):
        p, q = (x for x in range(4) if x not in (i, j))
        rest = F.when(F.col("c") == c, block[p] * 65536 + block[q]).otherwise(rest)
    thirds = F.array(*[F.struct(F.lit(t).alias("t"), F.shiftright(rest, s).bitwiseAND(F.lit((1 << w) - 1)).alias("part")) for t, (s, w) in enumerate(((0, 11), (11, 11), (22, 10)))])
    whole = F.array(F.struct(F.lit(-1).alias("t"), F.lit(0).cast("long").alias("part")))
    dealt = shared.select("print", "c", "key", F.explode(F.when(F.col("n") > SHARD, thirds).otherwise(whole)).alias("x")).select("print", "c", "key", "x.*")
    groups = dealt.groupBy("c", "key", "t", "part").agg(F.collect_list("print").alias("prints")).where(F.size("prints") > 1)
    return groups.select("prints").mapInArrow(_search(RADIUS), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of edges (a, b), component the lowest node; nodes that are lowest have no row.

    Alternating stars: each round links a node's larger neighbours, then its
    smaller ones, to its lowest neighbour. Every round is written to the shared
    folder, which cuts the lineage; only a count and two checksums reach the driver.
    """
    spark = edges.sparkSession

    def kept(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = shared_path(spark, "links")
        df.write.parquet(path)
        back = spark.read.schema("a long, b long").parquet(path)
        return back, path, tuple(back.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.hash("b", "a"))).first())

    e, path, sign = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while sign[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, old = sign, path
        e, path, sign = kept(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
        remove_path(spark, old)
        if sign == last:
            break
    return e.select(F.col("a").alias("node"), F.col("b").alias("component"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """A row for each row of docs: doc_id, _rid (the row's key beside doc_id), fingerprint (16 hexadecimal digits), component_id."""
    spark = docs.sparkSession
    path = shared_path(spark, "prints")
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), row_key().alias("rid"), F.col("text").cast("string").alias("text"))
    rows.mapInArrow(_fingerprints, "key long, rid long, print long").write.parquet(path)
    prints = spark.read.schema("key long, rid long, print long").parquet(path)
    distinct = prints.groupBy("print").agg(F.min("key").alias("low"), F.count("*").alias("n"))
    labels = components(links(distinct.select("print")))
    # Labels by fingerprint, then the lowest doc_id of each label, then back.
    named = distinct.join(labels, F.col("print") == F.col("node"), "left").select("print", "low", "n", F.coalesce("component", "print").alias("component"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    by_print = named.join(lowest, "component").select("print", "component", "component_id", "n")
    # A print may be that of very many copies.
    return salted_join(prints, by_print, "print", "inner", ["key", "rid"]).select(
        F.col("key").alias("doc_id"), F.col("rid").alias("_rid"), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id", F.col("component").alias("_component")
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: the lowest doc_id's (null lowest), of several the one with the lowest row key; of equal rows one."""
    return pick_first(docs, near_duplicates(docs))


def pick_first(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """docs with the first row of each ``_component`` of labelled, which has doc_id, _rid and _component for each row."""
    key, rid, nth = spare(docs, "key", "rid", "nth")
    lowest = F.lit(-(1 << 63))
    first = F.min(F.struct(F.coalesce(F.col("doc_id").cast("long"), lowest).alias("k"), F.col("_rid").alias("r"))).alias("first")
    chosen = labelled.groupBy("_component").agg(first).select(F.col("first.k").alias(key), F.col("first.r").alias(rid))
    rows = docs.withColumns({key: F.coalesce(F.col("doc_id").cast("long"), lowest), rid: row_key()})
    one = Window.partitionBy(key, rid).orderBy(key, rid)
    kept = rows.join(chosen.hint("merge"), [key, rid], "left_semi")
    return kept.withColumn(nth, F.row_number().over(one)).where(F.col(nth) == 1).select(docs.columns)


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
