"""The forest of hash prefixes against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventide.llm import vector_forest as v

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, every, k):
    """Neighbours by all inner products, in order."""
    fit = [(i, np.array(x, np.float32).astype(float)) for i, x in rows if x and all(c is not None and np.isfinite(c) for c in x) and any(x)]
    out = []
    for at, (i, x) in enumerate(fit):
        if i is None or i % every:
            continue
        others = [(-float((y * x).sum()), j is not None, j or 0) for b, (j, y) in enumerate(fit) if b != at and len(y) == len(x)]
        out += [(i, r + 1, j if known else None, -s) for r, (s, known, j) in enumerate(sorted(others)[:k])]
    return sorted(out, key=str)


def rows_of(n, seed=2, dim=8):
    rng = np.random.default_rng(seed)
    own = [(i, [float(c) for c in rng.standard_normal(dim).astype(np.float32) * rng.choice([0.5, 1, 3])]) for i in range(n)]
    hot = own[1][1]
    own += [(1000 + i, hot) for i in range(60)] + [own[10], own[10], own[3], (None, own[4][1]), (None, own[4][1]), (10, own[5][1])]
    own += [(2000, None), (2005, []), (2010, [0.0] * dim), (2015, [1.0] * (dim - 1) + [None]), (2020, [float("nan")] * dim), (2025, [float("inf")] + [1.0] * (dim - 1))]
    return own + [(3000 + 5 * i, [float(c) for c in rng.standard_normal(3).astype(np.float32)]) for i in range(9)] + [(4000, [-0.0, 2.0, 0.0]), (4001, [0.0, 2.0, 0.0])]


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_whole_reach_is_exact(spark):
    """Where all rows are in reach, ranks, ties, repeats and scores are those of all inner products."""
    rows = rows_of(150)
    vectors = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert found(v.neighbours(vectors, F.col("vec_id") % 5 == 0, 7)) == brute(rows, 5, 7)


def test_pieces_and_recall(spark, monkeypatch):
    """Many pieces and few candidates: rows are whole and in order, and most of the nearest are found among clustered vectors."""
    monkeypatch.setattr(v, "PIECE", 100)
    monkeypatch.setattr(v, "ENOUGH", 600)
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((40, 16)) * 2
    rows = [(i, [float(c) for c in (centres[i % 40] + rng.standard_normal(16)).astype(np.float32)]) for i in range(2000)]
    # A group of near copies, of which most share their strings.
    rows += [(5000 + i, [float(c) for c in (centres[0] + 1e-7 * rng.standard_normal(16)).astype(np.float32)]) for i in range(700)]
    got = found(v.neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 50 == 0, 10))
    want = brute(rows, 50, 10)
    near = {(q, i) for q, _, i, _ in want}
    assert len(got) == len(want) and len(near & {(q, i) for q, _, i, _ in got}) >= 0.9 * len(near)
    ids = {i: np.array(x, np.float32).astype(float) for i, x in rows}
    assert all(s == float((ids[q] * ids[i]).sum()) and q != i for q, _, i, s in got)


def test_doubles_and_clashing_names(spark):
    rows = [(i, [1.0 + i / 7, 2.0, -1.0], "s", 1) for i in range(30)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string, rank int")
    got = v.neighbours(vectors, F.col("vec_id") % 10 == 0, 3).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(got)] == [(q, r + 1, i) for q in (0, 10, 20) for r, i in enumerate((29, 28, 27))]


def test_empty(spark):
    assert v.neighbours(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []
    assert v.neighbours(spark.createDataFrame([(0, [0.0]), (20, None)], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []


def test_pieces():
    """Every string has one piece, in order; strings that the sample has often are dealt over the pieces they reach."""
    rng = np.random.default_rng(1)
    sample = np.sort(rng.integers(0, 1 << 63, (1000, v.TREES), np.uint64), axis=0)
    sample[300:700] = sample[300]
    cut = v.Pieces(100 * v.PIECE, np.full(1000, 4), sample)
    h = np.sort(rng.integers(0, 1 << 63, 5000, np.uint64))
    at = cut.of(4, 0, h, 0.5)
    assert (np.diff(at) >= 0).all() and at.min() >= 0 and at.max() <= 99
    same = cut.of(4, 0, np.full(1000, sample[300, 0]), np.linspace(0, 1, 1000))
    assert len(set(same.tolist())) >= 38 and (cut.of(9, 0, h, 0.5) == 0).all()


@pytest.mark.parametrize("level", [0, 1, 13, 63, 64])
def test_below(level):
    h = np.array([0, 5, 2**64 - 1, 0x123456789ABCDEF0], np.uint64)
    first, last = v.below(h, level)
    assert [(int(a), int(b)) for a, b in zip(first, last, strict=True)] == [(int(x) >> (64 - level) << (64 - level), int(x) | (2 ** (64 - level) - 1)) for x in h]
