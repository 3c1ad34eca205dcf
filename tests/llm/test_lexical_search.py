"""Lexical search against scoring in plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from eventide.llm import lexical_search as s

WORDS = "a the of Émile naïve x1 rare-word two words 日本 Zz q".split()


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, total = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for doc, c in counted:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score > 0:
                scored.append((-score, doc is not None, doc or 0))
        out += [(item, k + 1, d if known else None, -x) for k, (x, known, d) in enumerate(sorted(scored)[:top])]
    return Counter(out)


def tables(spark, seed=4, n=120):
    rng = np.random.default_rng(seed)
    text = lambda most: " ".join(rng.choice(WORDS, size=rng.integers(0, most))) + rng.choice(["", ".", "\n", "--\x00"])
    docs = [(i, text(30)) for i in range(n)]
    docs += [(None, "rare word"), (500, None), (501, ""), (502, "--"), docs[3], docs[3], (7, "rare word rare"), (-9, "rare " * 50_000)]
    items = [(i, text(8)) for i in range(12)] + [(20, None), (21, "!?"), (22, "unseen"), (0, "rare"), (None, "two words"), (23, "Rare RARE word")]
    items.append(items[2])
    return docs, items


@pytest.mark.parametrize(("segment", "block", "top", "stretch"), [(200, 10, 5, 50), (2_000_000, 200_000, 20, 1 << 20)])
def test_brute_force(spark, monkeypatch, segment, block, top, stretch):
    for name, value in (("SEGMENT", segment), ("BLOCK", block), ("STRETCH", stretch)):
        monkeypatch.setattr(s, name, value)
    docs, items = tables(spark)
    got = s.lexical_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string"), top)
    assert Counter(map(tuple, got.collect())) == brute(docs, items, top)


def test_empty_and_clashing(spark):
    docs = spark.createDataFrame([(1, "word", "t", 1, 2)], "doc_id long, text string, terms string, score int, rank int")
    items = spark.createDataFrame([(1, "word other", 5)], "item_id long, text string, df int")
    # The only document holds the term: its weight is 287 of 1000.
    assert [tuple(r) for r in s.lexical_search(docs, items).collect()] == [(1, 1, 1, 287 * (1_000_000_000 // (1000 + 1200)))]
    none = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert s.lexical_search(none[0], items).collect() == s.lexical_search(docs, none[1]).collect() == []


def test_ties():
    scores, ids = np.array([5, 9, 5, 0, 5, 5]), np.array([4, 1, 2, 0, 3, 2])
    assert s.highest(scores, ids, 3).tolist() == [1, 2, 5]
    assert s.highest(scores, ids, 9).tolist() == [1, 2, 5, 4, 0]


def test_impacts_beyond_64_bits():
    own = s.Segment()
    own.add(1, b"a b a")
    own.lengths = [10**10]
    (doc,) = own.rows(10**11, 10**13).to_pylist()
    m = 75 + 25 * 10**10 * 10**11 // 10**13
    assert np.frombuffer(doc["impacts"], "<u4").tolist() == [2 * 10**9 // (2000 + 12 * m), 10**9 // (1000 + 12 * m)]


def test_segments_are_small(spark):
    """What a task holds of an index is a few MB, however many terms its documents have."""
    docs = spark.range(60).selectExpr("id AS doc_id", "array_join(transform(sequence(1, 40000), x -> concat('t', x + 7 * id)), ' ') AS text").coalesce(1)
    rows = s.index(docs, *s.totals(docs)).selectExpr("length(places) + length(impacts) AS bytes", "size(doc_ids) AS docs").collect()
    assert sum(r.docs for r in rows) == 60 and max(r.bytes for r in rows) < 5 << 20
