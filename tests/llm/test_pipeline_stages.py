"""Each stage of the pipeline against a brute-force version, with planted near copies and look-alikes."""

import hashlib
import random

import corpus_pipeline
from test_line_runs import lines_brute
from test_near_copies import shingles
from test_operators import corpus, split, substring_brute  # noqa: F401


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_stages_with_planted_copies(spark, corpus, tmp_path):  # noqa: F811
    df, labels = corpus
    r = random.Random(8)
    base = [(x.doc_id, x.text) for x in df.select("doc_id", "text").orderBy("doc_id").limit(300).collect()]
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    pool, rows, planted = sorted({w for _, t in base for w in t.split()}), [], {}
    top = max(i for i, _ in base) + 1000
    for k in range(60):
        words = [r.choice(pool) for _ in range(300)]
        copy, times = list(words), r.randint(1, 12)
        for at in r.sample(range(300), times):
            copy[at] = f"edit{r.randrange(10**9)}"
        pair = [(top + 2 * k, " ".join(words)), (top + 2 * k + 1, " ".join(copy))]
        planted[top + 2 * k + 1] = similarity(*(shingles(t) for _, t in pair))
        rows += pair
    assert sum(0.8 <= s < 0.95 for s in planted.values()) > 10 and sum(0.6 < s < 0.8 for s in planted.values()) > 10
    docs, n = spark.createDataFrame(base + rows, "doc_id long, text string"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            n[name] = sorted((x.doc_id, x.text) for x in docs.collect())
    # The classifier is learned: what it keeps is taken as given.
    assert n["line_dedup"] == sorted(lines_brute(n["toxicity"], 8).items())
    sets, low = [(i, shingles(t)) for i, t in n["line_dedup"]], {i: i for i, _ in n["line_dedup"]}
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if similarity(a, b) >= 0.8 and low[i] != low[j]:
                x, y = sorted((low[i], low[j]))
                low = {q: x if v == y else v for q, v in low.items()}
    assert [i for i, _ in n["near_dedup"]] == sorted(set(low.values()))
    both = {i for i in planted if {i, i - 1} <= {q for q, _ in n["toxicity"]}}
    assert len(both) > 20 and all((planted[i] < 0.8) == (i in set(low.values())) for i in both)
    want = substring_brute(n["near_dedup"], 35)
    assert [(i, hashlib.sha256(b" ".join(split(t))).hexdigest()) for i, t in n["substring_dedup"]] == [(i, want[i, t][2]) for i, t in n["near_dedup"]]
    assert {x.doc_id for x in docs.select("doc_id").collect()} == {i for i, _ in n["substring_dedup"]}
