"""The pipeline's near-copy stage against a brute-force version."""

import random
from fractions import Fraction

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from eventide.llm import near_copies, simhash


def shingles(text, k=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def alike(a, b, k=5):
    """Whether the Jaccard similarity is 0.8 or more."""
    a, b = shingles(a, k), shingles(b, k)
    both = len(a & b)
    return a == b or 5 * both >= 4 * (len(a) + len(b) - both)


def kept_brute(rows, k=5):
    """The ids of rows (distinct ids) that are lowest in their component."""
    top = {i: i for i, _ in rows}

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for n, (i, a) in enumerate(rows):
        for j, b in rows[:n]:
            if alike(a, b, k):
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return {i for i in top if find(i) == i}


def edited(r, words, times):
    out = list(words)
    for at in r.sample(range(len(out)), times):
        out[at] = f"edit{r.randrange(10**9)}"
    return out


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    fresh = lambda n: [f"w{r.randrange(5000)}" for _ in range(n)]
    out, common = [], fresh(9)
    for n in (20, 60, 200, 400, 800):
        for share in (0.0, 0.005, 0.01, 0.015, 0.02, 0.025, 0.03, 0.05):
            text = fresh(n) + common
            out += [text, edited(r, text, round(n * share)), text[: round(n * r.choice((0.75, 0.8, 0.85)))]]
    r.shuffle(out)
    texts = [" ".join(x) for x in out] + ["", None, " \n", "one two", "One  Two", "one three", "a b c d e", "a b c d f"]
    return list(enumerate(texts))


def test_near_dedup_stage(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = kept_brute(rows)
    got = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert len(got) == len(set(got)) and set(got) == want and 20 < len(rows) - len(want)


def test_near_copies_order_and_repeats(spark, rows, monkeypatch):
    monkeypatch.setattr(near_copies, "FREQUENT", 1)
    monkeypatch.setattr(near_copies, "LAST", 50)
    monkeypatch.setattr(near_copies, "PAIRS", 3)
    monkeypatch.setattr(near_copies, "LARGE", 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in near_copies.keep_first_copy(docs, 2, 0.8).collect()} == kept_brute(rows, 2)
    twice = docs.union(docs).withColumn("doc_id", F.when(F.col("doc_id") == 0, None).otherwise(F.col("doc_id")))
    assert near_copies.keep_first_copy(twice, 5, 0.8).count() == len(kept_brute(rows))
    assert near_copies.keep_first_copy(docs.limit(0), 5, 0.8).count() == 0


def test_large_group_of_near_copies(spark):
    """The pairs compared grow with the group, not with its square."""
    r = random.Random(3)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(edited(r, base, 1))) for i in range(150)] + [(200, " ".join(edited(r, base, 30)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in near_copies.keep_first_copy(docs, 5, 0.8).collect()} == kept_brute(rows) == {0, 200}


def test_forest_is_trees():
    """Array trees find what the plain BK-tree and brute force find, equal prints and lone groups included."""
    r = random.Random(5)
    group, prints = [], []
    for g, n in enumerate((1, 2, 40, 300, 1, 7)):
        base = r.getrandbits(64)
        own = [base ^ sum(1 << b for b in r.sample(range(64), r.randrange(30))) for _ in range(n)]
        group += [g] * (n + n // 3)
        prints += own + own[: n // 3]
    value = np.array(prints, np.uint64)
    for radius in (0, 2, 16, 64):
        asked = np.array([i for i in range(len(prints)) if i % 3 < 2])
        got = {at: hits.tolist() for at, hits in simhash.BKForest(np.array(group), value).near(asked, radius)}
        assert got == {i: [j for j in range(len(prints)) if group[j] == group[i] and (prints[i] ^ prints[j]).bit_count() <= radius] for i in asked.tolist()}
        trees = {}
        for g, p in sorted(set(zip(group, prints, strict=True))):
            trees.setdefault(g, simhash.BKTree()).add(p)
        assert all({prints[j] for j in got[i]} == {trees[group[i]].values[k] for k in trees[group[i]].near(prints[i], radius)} for i in got)
    assert list(simhash.BKForest(np.empty(0, np.int64), np.empty(0, np.uint64)).near(np.empty(0, np.int64), 2)) == []


def test_search_is_by_trees(rows, monkeypatch):
    """Pairs within the radius come from BK-trees over SimHash, the rest beyond it from the scan; both together are whole."""
    sets = {near_copies.set_key(s): s for _, t in rows if len(s := near_copies.shingle_set(t, 5))}
    keys = list(sets)
    prints = {k: simhash.simhash(sets[k]) for k in keys}
    size, bits = [len(sets[k]) for k in keys], [near_copies.parity_bits(sets[k]) for k in keys]
    cell = [[0], [0], [0], [keys], [size], [[prints[k] for k in keys]], [keys], [bits], [[0] * len(keys)]]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in cell], names=list("hpqwnslbt"))

    def found():
        met = [x for out in near_copies._across(Fraction(4, 5), False)([batch]) for x in out.to_pylist()]
        return {(x["a"], x["b"]): ((prints[x["a"]] ^ prints[x["b"]]) & (2**64 - 1)).bit_count() for x in met}

    every = {(a, b) for a in keys for b in keys if a > b and 5 * (n := len(np.intersect1d(sets[a], sets[b]))) >= 4 * (len(sets[a]) + len(sets[b]) - n)}
    whole = found()
    assert every <= whole.keys() and sum(whole[p] <= near_copies.RADIUS for p in every) > 10
    # Without the trees only what is beyond the radius is left.
    monkeypatch.setattr(simhash.BKForest, "near", lambda self, asked, radius: ((at, np.array([at])) for at in asked.tolist()))
    assert found() == {p: d for p, d in whole.items() if d > near_copies.RADIUS}


def test_nearest_links_are_within_the_radius(rows):
    sets = {near_copies.set_key(s): s for _, t in rows if len(s := near_copies.shingle_set(t, 5))}
    keys = list(sets)
    prints = {k: simhash.simhash(sets[k]) for k in keys}
    group = [[7], [keys], [[len(sets[k]) for k in keys]], [[prints[k] for k in keys]]]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in group], names=list("hwns"))
    met = [x for out in near_copies._nearest(Fraction(4, 5))([batch]) for x in out.to_pylist()]
    assert met and all(x["a"] > x["b"] and ((prints[x["a"]] ^ prints[x["b"]]) & (2**64 - 1)).bit_count() <= near_copies.RADIUS for x in met)


def short_pairs(first):
    """Pairs of five shingles of which four stay: some are beyond the radius."""
    r = random.Random(2)
    return list(enumerate((" ".join(w[:n]) for w in ([f"w{r.randrange(5000)}" for _ in range(9)] for _ in range(100)) for n in (9, 8)), first))


def test_trees_choose_what_is_compared(spark, rows, monkeypatch):
    """One pass compares what the trees name and no other pair; only what its links leave apart gets to the pass beyond the radius."""
    passes, verified = [], near_copies._verified
    rows = rows + short_pairs(len(rows))

    def spy(docs, prints, pairs, shingle, bound):
        out = verified(docs, prints, pairs, shingle, bound)
        value = {r["whole"]: r["print"] for r in prints.collect()}
        met = {(r.a, r.b): ((value[r.a] ^ value[r.b]) & (2**64 - 1)).bit_count() for r in pairs.collect()}
        passes.append((met, {(r.a, r.b) for r in out.collect()}))
        return out

    monkeypatch.setattr(near_copies, "_verified", spy)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in near_copies.keep_first_copy(docs, 5, 0.8).collect()} == kept_brute(rows)
    (near, links), (far, others) = passes
    assert len(links) > 10 and all(d <= near_copies.RADIUS for d in near.values())
    assert others and all(d > near_copies.RADIUS for d in far.values())
    top = {i: i for pair in [*near, *far] for i in pair}
    for a, b in links:
        x, y = top[a], top[b]
        top = {i: x if t == y else t for i, t in top.items()}
    assert all(top[a] != top[b] for a, b in far)


def test_near_pass_is_the_trees(rows, monkeypatch):
    """What the trees don't find isn't met, and with all of a cell found more is."""
    sets = {near_copies.set_key(s): s for _, t in rows + short_pairs(len(rows)) if len(s := near_copies.shingle_set(t, 5))}
    keys = list(sets)
    cell = [[0], [0], [0], [keys], [[len(sets[k]) for k in keys]], [[simhash.simhash(sets[k]) for k in keys]], [keys], [[near_copies.parity_bits(sets[k]) for k in keys]], [[0] * len(keys)]]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in cell], names=list("hpqwnslbt"))

    def found(near, far):
        return {(x["a"], x["b"]) for out in near_copies._across(Fraction(4, 5), False, near, far)([batch]) for x in out.to_pylist()}

    near, far = found(True, False), found(False, True)
    assert near and far and not near & far and near | far == found(True, True)
    every = lambda self, asked, radius: ((at, np.arange(len(keys))) for at in asked.tolist())
    monkeypatch.setattr(simhash.BKForest, "near", every)
    assert found(True, False) == near | far
    monkeypatch.setattr(simhash.BKForest, "near", lambda self, asked, radius: ((at, np.array([at])) for at in asked.tolist()))
    assert found(True, False) == set() and found(False, True) == far
