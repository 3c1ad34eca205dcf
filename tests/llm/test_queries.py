"""The thin opN queries: their own columns against the libraries and plain Python."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as pt
import pytest
from test_operators import BYTE_BPE, TEXTS, WORD_BPE, groups_brute, lines_brute, substring_brute

from eventide.llm import queries, simhash

LANGS = ["en", "de", "en", None]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Distinct ids but for one repeated row, with columns that operators make themselves."""
    at = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, LANGS[k % 4], "src", -1) for k, (i, t) in enumerate(TEXTS) if i not in (20, 21)]
    spark.createDataFrame([*rows, rows[2]], "doc_id long, text string, lang string, source string, n_tokens long").repartition(3).write.parquet(f"{at}/documents.parquet")
    return at


@pytest.fixture(scope="module")
def rows(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def names(df):
    return set(df.columns)


def test_op1(spark, folder, rows):
    got = queries.QUERIES["op1_line_dedup"](spark, folder)
    want = lines_brute(list(dict.fromkeys(rows)), 3)
    assert Counter((r.doc_id, r.n_lines, r.n_removed, r.kept_sha256) for r in got.collect()) == Counter((i, want[i, t][0], want[i, t][1], hashlib.sha256(want[i, t][2].encode()).hexdigest()) for i, t in rows)


def test_op2(spark, folder, rows):
    got = queries.QUERIES["op2_substring_dedup"](spark, folder)
    want = substring_brute(rows, 35)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == Counter((i, *want[i, t]) for i, t in rows)


def test_op3(spark, folder, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORD_BPE)
    got = queries.QUERIES["op3_token_output"](spark, folder).collect()
    ids = {(i, t): np.append(tok.encode(t or "", add_special_tokens=False).ids, 2).astype("<u4").tobytes() for i, t in rows}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, len(ids[i, t]) // 4, zlib.crc32(ids[i, t])) for i, t in rows)
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.start for r in ordered] == np.cumsum([0, *(r.n_tokens for r in ordered)])[:-1].tolist()
    assert [r.doc_id for r in ordered] == sorted((r.doc_id for r in got), key=lambda i: (i is not None, i or 0))


def test_op6(spark, folder, rows):
    got = queries.QUERIES["op6_language_id"](spark, folder).collect()
    assert Counter((r.doc_id, r.held_out) for r in got) == Counter((i, i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in rows)
    blank = {i for i, t in rows if not any(map(str.isalpha, t or ""))}
    assert all((r.lang_pred == "und") == (r.doc_id in blank) and r.lang_pred in ("und", "en", "de") and 0 <= r.score <= 1 for r in got)


def test_op9(spark, folder, rows):
    got = queries.QUERIES["op9_simhash"](spark, folder).collect()
    prints = {t: simhash.simhash(simhash.shingle_hashes(t or "")) for _, t in rows}
    roots, low = groups_brute(sorted(set(prints.values()))), {}
    for i, t in rows:
        if i is not None:
            low[roots[prints[t]]] = min(low.get(roots[prints[t]], i), i)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == Counter((i, f"{prints[t] & (2**64 - 1):016x}", low.get(roots[prints[t]])) for i, t in rows)


def test_op10(spark, folder, rows):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    ref = tiktoken.Encoding("own", pat_str=pt.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = queries.QUERIES["op10_byte_bpe"](spark, folder).collect()
    ids = {t: np.array(ref.encode_ordinary(t or ""), "<u4").tobytes() for _, t in rows}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == Counter((i, len(ids[t]) // 4, sha(ids[t]), sha((t or "").encode())) for i, t in rows)
