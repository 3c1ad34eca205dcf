"""The pipeline's line stage against a brute-force version."""

import random

import corpus_pipeline
import pytest

from eventide.llm.line_dedup import dedup_lines


def lines_brute(rows, words, most=3):
    """Texts of rows (in order, distinct ids) without the later runs of fewer than ``most`` lines with that many words, and of ``most`` lines."""
    seen, out = set(), {}
    for i, t in rows:
        ls, gone = (t or "").split("\n"), set()
        for k in range(1, most + 1):
            for a in range(len(ls) - k + 1):
                key = tuple(ls[a : a + k])
                if k < most and sum(len(x.encode().split()) for x in key) < words:
                    continue
                if key in seen:
                    gone |= set(range(a, a + k))
                seen.add(key)
        out[i] = "\n".join(x for n, x in enumerate(ls) if n not in gone)
    return out


LONG = "nine words stand in this one line right here"
FIXED = [(1, LONG), (2, "own line\n" + LONG), (3, LONG), (4, "five words are not enough\nwith four more words"), (5, "x\nfive words are not enough\nwith four more words\ny"), (6, "short"), (7, "short"), (8, None), (9, ""), (10, LONG + "\n" + LONG), (11, "five words are not enough")]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_line_dedup_stage(spark, seed):
    r = random.Random(seed)
    pool = [" ".join(r.choice(["a", "b", "\tc ", "é"]) for _ in range(r.choice((0, 1, 3, 5, 7, 8, 9, 12)))) for _ in range(40)]
    rows = FIXED + [(100 + i, "\n".join(r.choice(pool) for _ in range(r.randint(1, 6)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {x.doc_id: x.text or "" for x in corpus_pipeline.line_dedup(spark, docs, "").collect()}
    assert got == lines_brute(rows, 8)
    assert got[2] == "own line" and got[3] == "" and got[5] == "x\ny" and got[7] == "short" and got[11] == "five words are not enough"


@pytest.mark.parametrize("window", [1, 2, 4])
def test_lengths_together(spark, window):
    """Windows of all lengths, also in texts of fewer lines than the longest, that share their lowest lines."""
    r = random.Random(window)
    pool = [" ".join(r.choice("ab") for _ in range(r.choice((0, 1, 2, 3, 6)))) for _ in range(25)]
    rows = FIXED + [(100 + i, "\n".join(r.choice(pool) for _ in range(r.randint(1, 7)))) for i in range(60)]
    got = {x.doc_id: x.text or "" for x in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), window, words=5).collect()}
    assert got == lines_brute(rows, 5, window)


def test_one_plan_for_all_lengths(spark):
    """The driver's memory grows with the plan: shorter runs add no scans, exchanges or joins to it."""
    docs = spark.createDataFrame(FIXED, "doc_id long, text string")

    def nodes(df):
        plan = df._jdf.queryExecution().executedPlan().toString()
        return {n: plan.count(n) for n in ("Scan", "Exchange", "Join")}

    assert nodes(dedup_lines(docs, words=8)) == nodes(dedup_lines(docs))
