"""Collocations against counting in plain Python."""

import re
from collections import Counter

import numpy as np
import pytest

from eventide.llm import collocations as c

WORDS = "in der tat ist das New York Times ein A-b é".split()


def brute(rows, max_n, least, share, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\n-\r]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, max_n + 1) for i in range(len(words) - k + 1))
    found = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        score, k = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        longer = (x for (o, q), x in f.items() if o == lang and len(q) > len(p) and x >= least and any(q[i : i + len(p)] == p for i in range(len(q))))
        if not any(100 * x >= share * a for x in longer):
            found.append((lang, -score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n[lang]))
    out, rank = [], Counter()
    for lang, score, a, p, left, right, total in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], p.decode(), -a, left, right, total, -score))
    return out


def rows_of(seed, n):
    rng = np.random.default_rng(seed)
    texts = [" ".join(rng.choice(WORDS, p=[0.2, 0.2, 0.1, 0.1, 0.1, 0.05, 0.05, 0.05, 0.05, 0.05, 0.05], size=rng.integers(0, 60))) for _ in range(n)]
    ends = [t.replace("tat ist", "tat, ist").replace("ein das", "ein\tdas").replace("das das", "das  das") for t in texts]
    return [(["de", "en", None][i % 3], t) for i, t in enumerate(ends)] + [("de", None), ("de", ""), ("fr", " .\n"), ("de", ends[0]), ("de", ends[0])]


@pytest.fixture
def small(monkeypatch):
    """Stretches and held hashes so small that texts are cut everywhere, and a filter that is nearly full."""
    monkeypatch.setattr(c, "STRETCH", 40)
    monkeypatch.setattr(c, "HELD", 50)
    monkeypatch.setattr(c, "BITS", 1 << 7)


@pytest.mark.parametrize(("max_n", "least", "share", "top"), [(3, 4, 50, 2000), (4, 3, 40, 7), (2, 5, 50, 2000)])
def test_brute_force(spark, max_n, least, share, top):
    rows = rows_of(3, 40)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = [tuple(r) for r in c.collocations(docs, max_n, least, share, top).collect()]
    assert got and sorted(got) == sorted(brute(rows, max_n, least, share, top))


def test_cut_everywhere(small):
    rows = rows_of(5, 30)
    for lang in ("de", "en"):
        f = Counter()
        texts = [(t or "").encode().translate(c._PLAIN) for o, t in rows if o == lang]
        before = []
        for part in c.stretches(b".".join(texts), c.STRETCH):
            words = before + part.replace(b".", b" . ").split()
            for _, phrases, n in c.Grams(words, len(before), lang, 3).counted(lambda n, h: np.ones(len(h), bool)):
                f.update(dict(zip(phrases.to_pylist(), n.tolist(), strict=True)))
            before = words[len(words) - 2 :] if len(words) >= 2 else words
        want = Counter()
        for t in texts:
            for piece in t.split(b"."):
                w = [x for x in piece.split(b" ") if x]
                want.update(b" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
        assert f == want


def test_exact_beyond_64_bits(spark):
    """Counts whose products pass 64 bits are scored exactly."""
    a, left, right = 3_000_000_019, 3_000_000_021, 3_100_000_001
    known = spark.createDataFrame([("en", "x y", 2, a), ("en", "x", 1, left), ("en", "y", 1, right)], "lang string, phrase string, words int, f long")
    (r,) = c.scored(known).collect()
    assert (r.a, r.l, r.r, r.score) == (a, left, right, 1_000_000 * a * a // (left * right))


def test_empty_clashing_and_long(spark):
    empty = spark.createDataFrame([], "lang string, text string, phrase string, f int")
    assert c.collocations(empty).collect() == []
    long = "go on " * 300_000
    docs = spark.createDataFrame([("en", long, "p", 1, 2), ("en", "word" * 2_000_000, "p", 1, 2), (None, None, None, None, None)], "lang string, text string, phrase string, rank int, score int")
    got = [tuple(r)[1:] for r in c.collocations(docs).collect()]
    n = 600_001
    score = 1_000_000 * 299_999**2 // 300_000**2
    assert got == [(1, "go on go", 299_999, 300_000, 300_000, n, score), (2, "on go on", 299_999, 300_000, 300_000, n, score)]
