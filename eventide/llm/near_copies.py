"""Near copies: SimHash fingerprints searched through BK-trees, then exact similarity of sets of word shingles.

Texts are near copies if their sets of shingles have a Jaccard similarity of at
least a bound. Each set has a 64-bit SimHash; sets of one size that differ as
much as 0.8 allows differ in 9.7 bits on average. Trees of fingerprints are
walked within ``RADIUS`` bits, and the whole sets of what they find are compared.

Blocks of the fingerprint can't name shards for so wide a radius. Prefix
filtering names them and loses no pair: under any one order of all shingles,
two sets of similarity ``t`` or more share one of the first
``n - ceil(t * n) + 1`` shingles of each, n its size. So each set goes to the
groups that these name, and each group has a tree.

The trees name the pairs: of the sets of a group only those that a walk finds
are compared, and joined up if they are similar. No radius is wide enough for
all, as the bits by which two sets differ scatter around a mean, so pairs beyond
it have a pass of their own. It takes sets that are still in different
components, and drops pairs whose parity bits differ in more places than the
sets may. In both passes, pairs that share too few prefix shingles for what is
left of them are dropped. No bound used drops a pair of the similarity.

A group of near copies isn't compared in all its pairs. Its sets first get
links to their nearest in trees over a few sets each. Before each of the passes,
it then gives as many pairs as would join its components, the closest by their
bits; only sets of different components are compared one with another.
Groups of over ``CELL`` sets are cut into parts, and pairs of parts are dealt to
tasks of their own.

The order is by hash, with the shingles that are frequent in a sample at the
end, which keeps the groups small. The sample bears on speed only.

Equal sets are joined up first. Shingles are those of :mod:`simhash`, each
counted once; a null or blank text has none and equals any other such text.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import mix64, remove_path, row_key, salted_join, shared_path
from eventide.llm.simhash import SEED, BKForest, components, pick_first, shingle_hashes, simhash

#: Documents in the sample, those that make a shingle frequent, and the shingles put last at most.
SAMPLE, FREQUENT, LAST = 16_000, 4, 100_000
#: Pairs that a task holds at once; sets in a group from which it is linked beforehand, and pairs tried then for a set.
PAIRS, LARGE, PARTNERS = 1 << 15, 32, 4
#: Sets of a group that meet in one cell, half from each of two parts.
CELL = 8192
#: Bits that stand for a set where pairs are made.
BITS = 1024
#: Differing bits of 64 up to which the trees search; at 0.8 two sets of one size differ in 9.7 on average.
RADIUS = 16
#: Groups, and sets of cells, that stand in one forest.
GROUPS, SETS = 8, 1 << 15
PAIR = ["a", "na", "b", "nb", "shared"]


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """Hashes of the text's shingles, as sorted signed integers."""
    return np.unique(shingle_hashes(text or "", shingle).view(np.int64))


def set_key(hashes: np.ndarray) -> int:
    key = xxhash.xxh64_intdigest(hashes.tobytes(), SEED) if len(hashes) else 0
    return key - (1 << 64) if key >> 63 else key


def parity_bits(hashes: np.ndarray) -> bytes:
    """For each remainder of a hash by ``BITS``, whether an odd number of the set's hashes has it."""
    return np.packbits(np.bincount(hashes.view(np.uint64) % np.uint64(BITS), minlength=BITS) & 1).tobytes()


def _lists(sets: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, sets)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *sets])))


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("key"), row_key().alias("rid"), F.col("text").cast("string").alias("text"))


def frequent(rows: DataFrame, shingle: int) -> np.ndarray:
    """Shingles that are frequent in a sample, sorted."""
    part = ceil(rows.count() / SAMPLE)

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.empty(0, np.int64), *(shingle_set(t, shingle) for t in batch.column(0).to_pylist())]))], names=["h"])

    drawn = rows.where(F.pmod("rid", F.lit(max(part, 1))) == 0).select("text")
    counts = drawn.mapInArrow(run, "h long").groupBy("h").count().where(F.col("count") >= FREQUENT)
    return np.sort(np.array([r.h for r in counts.orderBy(F.desc("count"), "h").limit(LAST).collect()], np.int64))


def _prefixes(shingle: int, bound: Fraction, last: np.ndarray):
    def prefix(s: np.ndarray) -> np.ndarray:
        late = np.isin(s, last, assume_unique=True)
        return np.concatenate([s[~late], s[late]])[: len(s) - ceil(bound * len(s)) + 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t, shingle) for t in batch.column(2).to_pylist()]
            made = [pa.array([f(s) for s in sets], pa.int64()) for f in (set_key, len, simhash)]
            made += [_lists([prefix(s) for s in sets]), pa.array([parity_bits(s) for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["key", "rid", "whole", "n", "print", "prefix", "bits"])

    return run


def _batch(pairs: dict) -> pa.RecordBatch:
    cells = [(*pair, c) for pair, c in pairs.items()]
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in cells], pa.int64()) for i in range(5)], names=PAIR)


def _pair(x: tuple[int, int], y: tuple[int, int]) -> tuple[int, int, int, int]:
    """Two (size, set) as set, size, set, size, the higher set first."""
    (n, w), (m, v) = (x, y) if x[1] > y[1] else (y, x)
    return w, n, v, m


def _nearest(bound: Fraction):
    """The nearest partners of each set within the radius, from trees over stretches of its group in an order of its own: a few for each set, whatever the group's size."""

    def run(batches):
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for first in range(0, batch.num_rows, GROUPS):
                met, stretch, prints, sets = {}, [], [], []
                for h, wholes, sizes, own in zip(*(c[first : first + GROUPS] for c in columns), strict=True):
                    mixed = mix64(np.array(wholes, np.int64).view(np.uint64) ^ np.uint64(h & 0xFFFFFFFFFFFFFFFF))
                    order = np.argsort(mixed, kind="stable").tolist()
                    stretch.append(np.arange(len(order)) // LARGE + (stretch[-1][-1] + 1 if stretch else 0))
                    prints += [own[i] for i in order]
                    sets += [(sizes[i], wholes[i]) for i in order]
                value = np.array(prints, np.int64).view(np.uint64)
                for i, hits in BKForest(np.concatenate(stretch), value).near(np.arange(len(sets)), RADIUS):
                    hits = hits[hits != i]
                    x = sets[i]
                    nearest = hits[np.argsort(np.bitwise_count(value[hits] ^ value[i]), kind="stable")].tolist()
                    good = [j for j in nearest if min(x[0], sets[j][0]) >= bound * max(x[0], sets[j][0])]
                    met |= {_pair(x, sets[j]): 1 for j in good[:PARTNERS]}
                yield _batch(met)

    return run


class Cell:
    """Sets of a group that meet, ordered by size."""

    def __init__(self, p, q, wholes, sizes, prints, labels, bits, parts):
        n = np.array(sizes, np.int64)
        order = np.argsort(n, kind="stable")
        self.apart, self.n, self.whole = p != q, n[order], [wholes[i] for i in order.tolist()]
        self.bits = np.frombuffer(b"".join(bits), np.uint64).reshape(len(sizes), -1)[order]
        self.prints, self.part = np.array(prints, np.int64).view(np.uint64)[order], np.array(parts)[order]
        own, self.label = np.unique(np.array(labels, np.int64)[order], return_inverse=True)
        self.top = np.arange(len(own))
        # Sets of the largest label need no search of their own: those of all others look at them too.
        self.large = self.label == np.bincount(self.label).argmax()


def _across(bound: Fraction, joining: bool, near: bool = True, far: bool = True):
    """Pairs of each cell whose labels differ and whose sizes and bits allow the similarity, with the times each was met.

    ``near``: those that the trees find within the radius; ``far``: those beyond it.
    ``joining``: only as many as join the cell's labels, the closest of each set first.
    """
    up, down = bound.numerator, bound.denominator

    def some(batch: pa.RecordBatch) -> Iterator[list[Cell]]:
        cells, held = [], 0
        for row in zip(*(c.to_pylist() for c in batch.columns[1:9]), strict=True):
            if len(set(row[5])) > 1:
                cells.append(Cell(*row))
                held += len(row[2])
            if held >= SETS:
                yield cells
                cells, held = [], 0
        if cells:
            yield cells

    def walked(cells: list[Cell], offsets: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
        """(cell, set, what the trees find for it) of all sets outside the largest labels."""
        cell_of = np.repeat(np.arange(len(cells)), np.diff(offsets))
        asked, none = np.flatnonzero(~np.concatenate([c.large for c in cells])), np.empty(0, np.int64)
        found = BKForest(cell_of, np.concatenate([c.prints for c in cells])).near(asked, RADIUS) if near else ((at, none) for at in asked.tolist())
        for at, hits in found:
            k = int(cell_of[at])
            yield k, at - offsets[k], hits - offsets[k]

    def beyond(c: Cell, i: int, start: int, end: int) -> np.ndarray:
        """Sets beyond the radius."""
        return start + np.flatnonzero(np.bitwise_count(c.prints[start:end] ^ c.prints[i]) > RADIUS)

    def pairs(cells: list[Cell]) -> Iterator[tuple]:
        offsets = np.cumsum([0, *(len(c.whole) for c in cells)]).tolist()
        ranges = [(np.searchsorted(c.n, -(-up * c.n // down)).tolist(), np.searchsorted(c.n, down * c.n // up, side="right").tolist()) for c in cells]
        for k, i, hits in walked(cells, offsets):
            c, start, end = cells[k], ranges[k][0][i], ranges[k][1][i]
            hits = hits[(hits >= start) & (hits < end)]
            if far:
                hits = np.concatenate([hits, beyond(c, i, start, end)])
            hits = hits[(c.label[hits] != c.label[i]) & (c.large[hits] | (hits < i))]
            if c.apart:  # pairs within a part meet in a cell of that part alone
                hits = hits[c.part[hits] != c.part[i]]
            # Sets that differ in d shingles differ in d bits at most.
            differ = np.bitwise_count(c.bits[hits] ^ c.bits[i]).sum(axis=1, dtype=np.int64)
            able = differ * (up + down) <= (c.n[hits] + c.n[i]) * (down - up)
            for j in hits[able][np.argsort(differ[able], kind="stable")].tolist():
                x, y = c.top[c.label[i]], c.top[c.label[j]]
                if joining and x == y:
                    continue
                yield _pair((int(c.n[i]), c.whole[i]), (int(c.n[j]), c.whole[j]))
                if joining:
                    c.top[c.top == y] = x

    def run(batches):
        met: dict[tuple, int] = {}
        for batch in batches:
            for cells in some(batch):
                for pair in pairs(cells):
                    met[pair] = met.get(pair, 0) + 1
                    if len(met) >= PAIRS:
                        yield _batch(met)
                        met = {}
        yield _batch(met)

    return run


def _verified(docs: DataFrame, prints: DataFrame, pairs: DataFrame, shingle: int, bound: Fraction) -> DataFrame:
    """The pairs (a, b) whose whole sets have the similarity."""
    spark, up, down = docs.sparkSession, bound.numerator, bound.denominator
    used = [shared_path(spark, "candidates"), shared_path(spark, "sets")]
    pairs.select("a", "b").write.parquet(used[0])
    candidates = spark.read.schema("a long, b long").parquet(used[0])

    def sets(batches):
        for batch in batches:
            made = [shingle_set(t, shingle) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([set_key(s) for s in made], pa.int64()), _lists(made)], names=["whole", "hashes"])

    wanted = candidates.select(F.explode(F.array("a", "b")).alias("whole")).distinct()
    chosen = prints.select("rid", "whole").join(wanted, "whole", "left_semi").groupBy("whole").agg(F.min("rid").alias("rid")).select("rid")
    texts = _rows(docs).join(chosen, "rid", "left_semi").select("text")
    texts.mapInArrow(sets, "whole long, hashes array<long>").dropDuplicates(["whole"]).write.parquet(used[1])
    whole = spark.read.schema("whole long, hashes array<long>").parquet(used[1])
    both = candidates.join(whole.select(F.col("whole").alias("a"), F.col("hashes").alias("x")), "a").join(whole.select(F.col("whole").alias("b"), F.col("hashes").alias("y")), "b")
    # Jaccard: i / (x + y - i) >= up / down.
    good = both.where(F.size(F.array_intersect("x", "y")) * (up + down) >= (F.size("x") + F.size("y")) * up).select("a", "b")
    path = shared_path(spark, "similar")
    good.write.parquet(path)
    for done in used:
        remove_path(spark, done)
    return spark.read.schema("a long, b long").parquet(path)


def similar_links(docs: DataFrame, prints: DataFrame, shingle: int, bound: Fraction) -> DataFrame:
    """Links (a, b), a > b, that join all different sets of that similarity or more, directly or by way of others."""
    spark, up, down = docs.sparkSession, bound.numerator, bound.denominator
    sets = prints.groupBy("whole").agg(F.first("n").alias("n"), F.first("print").alias("print"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits"))
    placed = sets.select(F.explode("prefix").alias("h"), "whole", "n", "print")
    # Most shingles stand in one set only; they leave before groups are made.
    counts = placed.groupBy("h").count().where("count > 1")
    used = shared_path(spark, "placed")
    placed.join(counts, "h").write.parquet(used)
    placed = spark.read.schema("h long, whole long, n long, print long, count long").parquet(used)
    pair = ", ".join(f"{x} long" for x in PAIR)
    links: DataFrame | None = None

    def verified(pairs: DataFrame) -> DataFrame:
        """All links so far, with those of the pairs."""
        made = _verified(docs, prints, pairs, shingle, bound)
        return made if links is None else links.unionByName(made)

    parts = F.greatest(F.ceil(F.col("count") / (CELL // 2)), F.lit(1)).cast("int")
    part = F.when(F.col("count") <= CELL, F.lit(0)).otherwise(F.pmod(F.xxhash64("whole"), parts).cast("int"))
    cells = F.when(F.col("count") <= CELL, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), parts - 1))
    large = placed.where(F.col("count") > LARGE)

    def met(near: bool, joining: bool) -> DataFrame:
        """Pairs of sets that the links so far leave in different components."""
        dealt = (large if joining else placed).select("h", "whole", "n", "print", part.alias("part"), F.explode(cells).alias("other")).select("h", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "whole", "n", "print", "part")
        if links is None:
            labels = spark.createDataFrame([], "whole long, component long")
        else:
            labels = components(links).select(F.col("node").alias("whole"), "component")
        named = sets.select("whole", "bits").join(labels, "whole", "left").select("whole", F.coalesce("component", "whole").alias("label"), "bits")
        cell = dealt.join(named, "whole").groupBy("h", "p", "q").agg(F.collect_list(F.struct("whole", "n", "print", "label", "bits", "part")).alias("s"), F.min("label").alias("low"), F.max("label").alias("high"))
        groups = cell.where("low < high").select("h", "p", "q", *[f"s.{c}" for c in ("whole", "n", "print", "label", "bits", "part")])
        return groups.mapInArrow(_across(bound, joining, near, not near), pair).groupBy("a", "na", "b", "nb").agg(F.sum("shared").alias("shared"))

    # Large groups first get a few links for each set. Sets that these join need no pair of their own. Without large groups these passes would be empty.
    there = (placed.agg(F.max("count").alias("n")).first()["n"] or 0) > LARGE
    if there:
        listed = large.withColumn("p", part).groupBy("h", "p").agg(F.collect_list(F.struct("whole", "n", "print")).alias("s")).select("h", "s.whole", "s.n", "s.print")
        nth = F.row_number().over(Window.partitionBy("a").orderBy(F.xxhash64("a", "b")))
        links = verified(listed.mapInArrow(_nearest(bound), pair).select("a", "b").distinct().withColumn("nth", nth).where(F.col("nth") <= PARTNERS))

    # What a prefix leaves out is one less than ceil(bound * n).
    most = F.col("shared") + F.expr(f"(greatest(na, nb) * {up} + {down - 1}) div {down} - 1")
    for near in (True, False):
        if there:
            links = verified(met(near, True))
        links = verified(met(near, False).where(most * (up + down) >= (F.col("na") + F.col("nb")) * up))
    remove_path(spark, used)
    return links


def near_copies(docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """A row for each row of docs: doc_id, _rid and _component, the same for all that a chain of near copies joins."""
    spark, bound = docs.sparkSession, Fraction(str(similarity))
    path = shared_path(spark, "prefixes")
    rows = _rows(docs)
    schema = "key long, rid long, whole long, n long, print long, prefix array<long>, bits binary"
    rows.mapInArrow(_prefixes(shingle, bound, frequent(rows, shingle)), schema).write.parquet(path)
    prints = spark.read.schema(schema).parquet(path)
    labels = components(similar_links(docs, prints, shingle, bound))
    own, counts = prints.select("key", "rid", "whole"), prints.groupBy("whole").agg(F.count("*").alias("n"))
    # A set may be that of very many copies.
    named = salted_join(own, labels.select(F.col("node").alias("whole"), "component"), "whole", "left", ["key", "rid"], counts)
    return named.select(F.col("key").alias("doc_id"), F.col("rid").alias("_rid"), F.coalesce("component", "whole").alias("_component"))


def keep_first_copy(docs: DataFrame, shingle: int, similarity: float) -> DataFrame:
    """docs with one row of each group of near copies, chosen as by :func:`simhash.keep_first`."""
    return pick_first(docs, near_copies(docs, shingle, similarity))
