"""Every operator against a brute-force version on small tables with awkward rows."""

import base64
import hashlib
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers as pt
import pytest
import xxhash
from pyspark.sql import functions as F

from eventide.llm import byte_bpe, fingerprints, language_id, line_dedup, packing, quality, simhash, substring_dedup, token_output, toxicity, word_bpe

WORD_BPE, BYTE_BPE = pt.path("word_bpe_49k.json"), pt.path("byte_bpe_50k.tiktoken")
R = random.Random(5)
PASSAGE = " ".join(f"p{i}" for i in range(45))
LINES = "alpha line\nbeta line\ngamma line\ndelta line"


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(1, 7))) for _ in range(n))


TEXTS = [
    (1, words(60, 1) + " " + PASSAGE + " " + words(20, 2)), (2, PASSAGE + "\n" + words(80, 3)), (3, words(200, 4)), (4, words(200, 4)), (5, words(199, 4) + " changed"), (6, None), (7, ""), (8, "   \n\t "), (9, "one"), (10, "two words"),
    (11, LINES + "\n" + words(10, 5)), (12, words(9, 6) + "\n" + LINES), (13, LINES + "\nx\n" + LINES), (14, "same " * 400), (15, "é ß Ω 中文 🦀 İ ǰ \x1c\x85 " * 3), (16, words(9000, 7)), (17, "the cat " + "." * 3000), (18, "A" * 5000), (19, "<|endoftext|> it's I'M 12 345"),
    (None, "null id " + words(50, 8)), (20, words(40, 9)), (20, words(40, 10)), (21, words(70, 11)), (21, words(70, 11)), (22, "trailing \n\n lines \n"), (-3, "minus"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 1.5, "n") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, score string, n_words double, lang string").repartition(3)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def split(t):
    return (t or "").encode().split()


def unique_rows():
    """Rows that repeat doc_id and text count once."""
    return list(dict.fromkeys(TEXTS))


def rid(df):
    return df


# Line dedup.


def lines_brute(rows, w):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, out = {}, {}
    for i, t in order:
        ls = (t or "").split("\n")
        gone = set()
        for k in range(len(ls) - w + 1):
            key = tuple(ls[k : k + w])
            if key in seen:
                gone |= set(range(k, k + w))
            seen.setdefault(key, (i, k))
        out[i, t] = (len(ls), len(gone), "\n".join(x for k, x in enumerate(ls) if k not in gone))
    return out


def test_line_dedup(docs, empty):
    got = line_dedup.dedup_lines(docs)
    want = lines_brute([r for r in unique_rows() if r[0] != 20], 3)
    plain = {(i, t): v for (i, t), v in want.items()}
    rows = [(r.doc_id, (r.n_lines, r.n_removed, r.text or "")) for r in got.collect() if r.doc_id != 20]
    assert sorted(rows, key=repr) == sorted(((i, plain[i, t]) for i, t in TEXTS if i != 20), key=repr)
    assert sum(r[1][1] for r in rows) == 12 and set(docs.columns) <= set(got.columns)
    assert line_dedup.dedup_lines(empty).count() == 0


@pytest.mark.parametrize("w", [1, 2, 4])
def test_line_dedup_random(spark, w):
    r = random.Random(w)
    rows = [(i, "\n".join(r.choice("abcd") for _ in range(r.randint(0, 9)))) for i in range(60)]
    got = {x.doc_id: (x.n_lines, x.n_removed, x.text) for x in line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), w).collect()}
    assert got == {i: v for (i, _), v in lines_brute(rows, w).items()}


# Substring dedup.


def substring_brute(rows, w):
    c = Counter(tuple(x[k : k + w]) for _, t in rows for x in [split(t)] for k in range(len(x) - w + 1))
    out = {}
    for i, t in rows:
        x = split(t)
        gone = [False] * len(x)
        for k in range(len(x) - w + 1):
            if c[tuple(x[k : k + w])] > 1:
                gone[k : k + w] = [True] * w
        out[i, t] = (len(x), sum(gone), hashlib.sha256(b" ".join(a for a, g in zip(x, gone) if not g)).hexdigest())
    return out


def test_substring_dedup(docs, empty):
    got = substring_dedup.dedup_substrings(docs)
    want = substring_brute(TEXTS, 35)
    assert sorted(((r.doc_id, (r.n_words, r.n_removed, r.kept_sha256)) for r in got.collect()), key=repr) == sorted(((i, want[i, t]) for i, t in TEXTS), key=repr)
    by = {r.doc_id: r.text for r in got.collect()}
    assert PASSAGE not in by[1] and by[6] is None and by[3] == "" and by[20] is not None and by[22] == "trailing \n\n lines \n"
    assert "score" in got.columns and substring_dedup.dedup_substrings(empty).count() == 0


def test_substring_dedup_of_repeated_rows(spark):
    """Rows with the same doc_id and text are copies of each other."""
    long, short = words(50, 70), words(20, 71)
    got = substring_dedup.dedup_substrings(spark.createDataFrame([(1, long), (1, long), (2, short), (2, short), (3, words(50, 72))], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in got) == [(1, 50, 50), (1, 50, 50), (2, 20, 0), (2, 20, 0), (3, 50, 0)]


INSIDE = ["_rid", "_gone", "_hit_id", "_hit_rid", "_text", "_anchors", "_repeats", "_key", "_nth", "_bucket", "_guest", "_first", "_host", "n", "kind", "features", "bucket", "source", "salt", "hot", "i", "fp", "lang", "source_", "ids", "start"]


def test_clashing_names(spark, corpus):
    """Columns that have the names used inside come back as they were."""
    df, labels = corpus
    base = [(r.doc_id, r.text) for r in df.where("doc_id < 40").collect()] + [(901, LINES), (902, LINES), (903, PASSAGE), (904, PASSAGE), (905, None)]
    plain = spark.createDataFrame(base, "doc_id long, text string")
    clash = plain.select("*", *[F.concat(F.lit(c + "-"), F.col("doc_id")).alias(c) for c in INSIDE])
    model, reference, lid = toxicity.train(df, labels), quality.references(df), language_id.train(df)
    made = {
        "lines": line_dedup.dedup_lines, "words": lambda d: line_dedup.dedup_lines(d, words=8), "substrings": substring_dedup.dedup_substrings, "first": simhash.keep_first,
        "toxicity": lambda d: toxicity.score(d, model), "quality": lambda d: quality.judge(d, reference), "language": lambda d: language_id.identify(d, lid), "next": lambda d: fingerprints.with_next(d, ["doc_id"]),
    }
    for name, f in made.items():
        out = f(clash)
        assert set(clash.columns) <= set(out.columns), name
        got, want = out.collect(), f(plain).collect()
        assert all(r[c] == f"{c}-{r.doc_id}" for r in got for c in INSIDE), name
        own = [c for c in f(plain).columns if c not in INSIDE]
        assert sorted((repr([r[c] for c in own]) for r in got)) == sorted(repr([r[c] for c in own]) for r in want), name


@pytest.mark.parametrize("w", [1, 2, 3, 5, 8])
def test_substring_dedup_random(spark, w):
    r = random.Random(w)
    rows = [(i, " ".join(r.choice("abc" if w > 3 else "abcdefghijklmnop") for _ in range(r.randint(0, 14)))) for i in range(50)]
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_sha256) for x in substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"), w).collect()}
    assert got == {i: v for (i, _), v in substring_brute(rows, w).items()}


# Tokens.


def test_encoders_equal_the_libraries():
    import tiktoken
    from tokenizers import Tokenizer

    alphabet = "ab  \n\t.,'sé中Ω1\x1c\x85\xa0!İǰ"
    texts = ["".join(R.choice(alphabet) for _ in range(R.randrange(60))) for _ in range(3000)] + [t or "" for _, t in TEXTS]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    ref = tiktoken.Encoding("own", pat_str=pt.PATTERN, mergeable_ranks=ranks, special_tokens={})
    bpe = byte_bpe.ByteBPE(BYTE_BPE, pt.PATTERN)
    made = bpe.encode_batch(texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in made] == [ref.encode_ordinary(t) for t in texts]
    assert [bpe.decode(x) for x in made] == [t.encode() for t in texts]
    tok, own = Tokenizer.from_file(WORD_BPE), word_bpe.WordBPE(WORD_BPE)
    assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_batch(texts)] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def test_tables_keep_to_their_bounds(monkeypatch):
    texts = [t or "" for _, t in TEXTS]
    a, b = word_bpe.WordBPE(WORD_BPE), byte_bpe.ByteBPE(BYTE_BPE, pt.PATTERN)
    want = a.encode_batch(texts), b.encode_batch(texts)
    for m in (word_bpe, byte_bpe):
        monkeypatch.setattr(m, "CHUNK", 50)
    for table in (a.table, b.pieces, b.stretches):
        table.most = 2000
    for _ in range(3):
        assert ([x for t in texts for x in a.encode_batch([t])], [x for t in texts for x in b.encode_batch([t])]) == want
    assert max(len(x) for x in (a.table, b.pieces, b.stretches)) < 60


def test_new_pieces_go_through_the_model_together():
    """One call of the library for STEP new pieces, none for known ones; texts of all kinds, with every contraction."""
    from tokenizers import Tokenizer

    r = random.Random(8)
    tok, own = Tokenizer.from_file(WORD_BPE), word_bpe.WordBPE(WORD_BPE)
    calls, model = [], own.model
    own.model = SimpleNamespace(encode_batch_fast=lambda texts, **k: calls.append(len(texts)) or model.encode_batch_fast(texts, **k))
    words = ["".join(r.choice("abcdefghé") for _ in range(9)) for _ in range(word_bpe.STEP + 900)]
    for _ in range(3):
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_batch([" ".join(words)])] == [tok.encode(" ".join(words), add_special_tokens=False).ids]
    # Pieces stay from the second time on that they are new.
    assert calls == [1] * 4 and sorted(own.table.values()) == list(range(len(own.table))) and own.table.codes == len(own.table)
    texts = ["".join(r.choice(["'", "s", "t", "m", "d", "re", "ve", "ll", "L", "É", "7", "\xb2", "!", "*", " ", "\n", "\x1f", "\xa0", "\xb5", "\xff", "<", "|", "\u0301", "\u212a", "\u1e9e", "</w>", "\x00"][: r.choice([20, 27])]) for _ in range(r.randrange(25))) for _ in range(4000)]
    own.table.most = 20_000
    for a in range(0, len(texts), 400):
        assert [np.frombuffer(x, "<u4").tolist() for x in own.encode_batch(texts[a : a + 400])] == [e.ids for e in tok.encode_batch(texts[a : a + 400], add_special_tokens=False)]


def test_texts_cut_together_give_the_pieces_of_each():
    r = random.Random(9)
    alphabet = ["'", "s", "t", "m", "d", "re", "ve", "ll", "l", "v", "É", "7", "\xb2", "!", "*", " ", "\n", "\x85", "\xa0", "\xb5", "\xd7", "\xff", "\x00"]
    for _ in range(1500):
        texts = ["".join(r.choice(alphabet) for _ in range(r.randrange(20))) for _ in range(r.randrange(5))]
        pieces, counts = word_bpe.cut_plain(texts)
        want = [word_bpe._PIECE.findall(t.lower()) for t in texts]
        assert pieces == [x for p in want for x in p] and counts.tolist() == [len(p) for p in want], texts


def test_long_pieces_equal_the_library():
    import tiktoken

    r = random.Random(6)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))}
    ref = tiktoken.Encoding("own", pat_str=pt.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["".join(r.choice(alphabet) for _ in range(n)) for alphabet in ("etaoin", "=-", "ab", "приветдом", "中文字汉语", "a", "abcdefghijklmnopqrstuvwxyz") for n in (255, 256, 257, 700, 3000)]
    bpe = byte_bpe.ByteBPE(BYTE_BPE, pt.PATTERN)
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.encode_batch(texts)] == [ref.encode_ordinary(t) for t in texts]


def test_a_long_row_merges_the_leftmost_minimum_pair_each_time():
    """Ranks for which merging all places of a pair at once would be wrong."""
    r = random.Random(7)
    for _ in range(30):
        bpe = byte_bpe.ByteBPE.__new__(byte_bpe.ByteBPE)
        pairs = {(r.randrange(9), r.randrange(9)): k for k in r.sample(range(3, 40), 25)}
        bpe.table = byte_bpe.PairTable(np.array([a << 32 | b for a, b in pairs], np.uint64), np.array(list(pairs.values()), np.int32))
        ids = [r.randrange(3) for _ in range(60)]
        want = list(ids)
        while found := [(pairs[p], i) for i, p in enumerate(zip(want, want[1:])) if p in pairs]:
            low, i = min(found)
            want[i : i + 2] = [low]
        assert bpe._long(np.array(ids, np.int32)).tolist() == want


def encoded(end):
    own = word_bpe.WordBPE(WORD_BPE)
    return [np.append(np.frombuffer(x, "<u4"), end).astype("<u4") for x in own.encode_batch([t or "" for _, t in TEXTS])]


@pytest.mark.parametrize("values", [[], [5], [7] * 300, list(range(300)), [0, 2**32 - 1] * 100, [1] * 120 + [2**31] * 8 + [3] * 5])
def test_blocks_round_trip(values):
    ids = np.array(values, np.uint32)
    raw, starts = token_output.pack_blocks(ids)
    back = token_output.unpack_blocks(np.frombuffer(raw, np.uint8), starts[:-1]) if len(ids) else ids
    assert back[: len(ids)].tolist() == values
    docs, counts, out = token_output.unpack_segment(token_output.pack_segment([(3, len(ids)), (None, 0)], ids))
    assert docs == [3, None] and counts.tolist() == [len(ids), 0] and out.tolist() == values
    # Any block by itself.
    if len(values) > 256:
        assert token_output.unpack_blocks(np.frombuffer(raw, np.uint8), starts[1:2]).tolist() == values[128:256]


def test_random_blocks_round_trip():
    r = np.random.default_rng(1)
    for _ in range(30):
        ids = np.where(r.random(1000) < 0.05, r.integers(0, 1 << 32, 1000), r.integers(0, 1 << int(r.integers(1, 20)), 1000)).astype(np.uint32)
        raw, starts = token_output.pack_blocks(ids)
        assert token_output.unpack_blocks(np.frombuffer(raw, np.uint8), starts[:-1])[:1000].tolist() == ids.tolist()


def test_token_output(spark, docs, empty, tmp_path, monkeypatch):
    token_output.write_ids(docs, str(tmp_path / "a"), WORD_BPE, 2)
    rows = token_output.read_ids(spark, str(tmp_path / "a")).collect()
    ids = {}
    for (i, t), x in zip(TEXTS, encoded(2), strict=True):
        ids.setdefault(i, []).append(x.tobytes())
    assert Counter((r.doc_id, bytes(r.ids)) for r in rows) == Counter((i, x) for i, xs in ids.items() for x in xs)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    token_output.write_ids(empty, str(tmp_path / "b"), WORD_BPE, 2)
    assert token_output.read_ids(spark, str(tmp_path / "b")).count() == 0


def pieces_hold(rows, want, limits):
    by, seqs = {}, {}
    for r in rows:
        by.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    for s in seqs.values():
        s.sort(key=lambda r: r.offset)
        assert [r.offset for r in s] == [sum(x.length for x in s[:k]) for k in range(len(s))]
        assert sum(r.length for r in s) <= limits[0] and len(s) <= limits[1]
    return seqs


def test_packing(docs, empty):
    rows = packing.pack(docs.where("doc_id NOT IN (20, 21)"), WORD_BPE, 1).collect()
    want = {i: x for (i, _), x in zip(TEXTS, encoded(1), strict=True) if i not in (20, 21) and i is not None}
    seqs = pieces_hold(rows, want, (2048, 512))
    for i, x in want.items():
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in own) == x.tobytes() and [r.start for r in own] == [sum(o.length for o in own[:k]) for k in range(len(own))] and {r.doc_tokens for r in own} == {len(x)}
    assert len(seqs) <= -(-sum(map(len, want.values())) // 2048) + 3
    assert packing.pack(empty, WORD_BPE, 1).count() == 0
    with pytest.raises(ValueError):
        packing.pack(docs, WORD_BPE, 1, max_tokens=0)


def test_packing_keeps_all_limits():
    r = random.Random(3)
    packer = packing.Packer(64, 4, 40)
    placed, total = [], 0
    for i in range(900):
        n = r.choice([1, 3, 10, 30, 64, 65, 200])
        total += n
        placed += packer.add(packing.Piece(i, bytes(4 * n), 0, n, r.randint(0, n), n))
    placed += packer.finish()
    seqs = {}
    for p, s, o in placed:
        seqs.setdefault(s, []).append((o, p))
    for own in seqs.values():
        own.sort(key=lambda x: x[0])
        assert sum(p.n for _, p in own) <= 64 and len(own) <= 4 and sum(p.loss() for _, p in own) <= 40
    assert sum(p.n for p, _, _ in placed) == total and len(seqs) == len({s for s in seqs})


def test_packing_prefers_the_greatest_dot_product():
    packer = packing.Packer(10, 5, 10)
    list(packer.add(packing.Piece(1, bytes(4 * 3), 0, 3, 0, 3)))
    list(packer.add(packing.Piece(2, bytes(4 * 7), 0, 7, 0, 7)))
    assert [(p.doc, s, o) for p, s, o in packer.finish()] == [(2, 0, 0), (1, 0, 7)]


@pytest.mark.parametrize("size", [1, 3, 6, 40])
def test_packing_of_short_documents_has_little_padding(size):
    packer = packing.Packer()
    placed = [x for i in range(20_000) for x in packer.add(packing.Piece(i, bytes(4 * size), 0, size, 0, size))] + list(packer.finish())
    assert len({s for _, s, _ in placed}) == -(-20_000 * size // 2048)
    assert sum(p.n for p, _, _ in placed) == 20_000 * size


def test_packing_query(spark, docs, tmp_path):
    """op5_packing's own columns, from the library's ids."""
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    rows = packing.op5_packing(spark, str(tmp_path)).collect()
    want = Counter((i, zlib.crc32(x.tobytes()), len(x)) for (i, _), x in zip(TEXTS, encoded(1), strict=True) if len(x) < 2048)
    whole = Counter((r.doc_id, r.ids_crc32, r.doc_tokens) for r in rows if r.start == 0 and r.length == r.doc_tokens)
    assert not whole - want and sum(r.length for r in rows) == sum(map(len, encoded(1)))
    seqs = pieces_hold(rows, want, (2048, 2048))
    assert sum(sum(r.length for r in s) for s in seqs.values()) > 0.9 * 2048 * (len(seqs) - 3)
    assert rows[0].asDict().keys() == {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"}


# Fingerprints.


def test_fingerprints(spark, docs, empty):
    rows = fingerprints.with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ["text"]).collect()
    ordered = sorted(((i, t or "") for i, t in TEXTS), key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode()))
    want = Counter((i, t, ordered[(k + 1) % len(ordered)][1]) for k, (i, t) in enumerate(ordered))
    assert Counter((r.doc_id, r.text, r._next.text) for r in rows) == want
    assert fingerprints.with_next(empty.select("doc_id", "text"), ["text"]).count() == 0
    one = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    assert fingerprints.with_next(one, ["text"]).first()._next.text == "x"


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def tree_brute(text):
    """Root, and for each section its digest and paragraphs: (digest, leaf digests)."""
    paragraphs = [[sha(p[i : i + 32]) for i in range(0, len(p), 32)] for p in text.split("\n")]
    made = [(sha("".join(ls)), ls) for ls in paragraphs]
    parts = [made[i : i + 16] for i in range(0, len(made), 16)]
    heads = [sha("".join(h for h, _ in ps)) for ps in parts]
    return sha("".join(heads)), [(h[:8], tuple((d[:8], tuple(x[:8] for x in ls)) for d, ls in ps)) for h, ps in zip(heads, parts)]


def shown_brute(text):
    top, parts = tree_brute(text)
    return top + ":" + "/".join(h + "=" + ".".join(d + "".join(ls) for d, ls in ps) for h, ps in parts)


def likeness_brute(a, b):
    (ra, sa), (rb, sb) = tree_brute(a), tree_brute(b)
    if ra == rb:
        return 1.0
    both = set(sa) & set(sb)
    shared = sum(len(ls) for _, ps in both for _, ls in ps)
    pa_, pb = ({p for s in set(x) - both for p in s[1]} for x in (sa, sb))
    same = pa_ & pb
    shared += sum(len(ls) for _, ls in same)
    la, lb = ({x for p in ps - same for x in p[1]} for ps in (pa_, pb))
    total = 2 * shared + len(la) + len(lb)
    return 2.0 * (shared + len(la & lb)) / total if total else 0.0


def test_fingerprint_query(spark, docs, tmp_path):
    """All columns of op7_fingerprints against a brute-force version."""
    more = [(900 + i, "\n".join(words(R.randrange(30), 7 * i + k) for k in range(R.randrange(1, 60))), "x", 0.0, "n") for i in range(12)]
    rows = docs.where("doc_id IS NULL OR doc_id NOT IN (20, 21)").collect() + more
    spark.createDataFrame(rows, docs.schema).repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    own = sorted(((r[0], r[1] or "") for r in rows), key=lambda x: (x[0] is not None, x[0] or 0))
    got = {r.doc_id: r for r in fingerprints.op7_fingerprints(spark, str(tmp_path)).collect()}
    assert len(got) == len(own)
    for k, (i, t) in enumerate(own):
        after = own[(k + 1) % len(own)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), sha(changed), shown_brute(t), shown_brute(changed))
        assert abs(r.near_edited - likeness_brute(t, changed)) < 1e-12 and abs(r.near_next - likeness_brute(t, after)) < 1e-12


def test_fingerprint_likeness_and_edits(spark):
    base = "\n".join(words(12, i) for i in range(40))
    changed = base.split("\n")
    changed[17] = "edited " + changed[17]
    rows = spark.createDataFrame([(base, base), (base, "\n".join(changed)), (base, words(300, 99)), ("", ""), ("", "x"), ("ab", "ab"), (base, base + "\nmore"), ("", "\n")], "a string, b string")
    f = rows.select(fingerprints.fingerprint(F.col("a")).alias("a"), fingerprints.fingerprint(F.col("b")).alias("b"))
    got = f.select("a", "b", fingerprints.likeness(F.col("a"), F.col("b")).alias("l"), fingerprints.differing(F.col("a"), F.col("b")).alias("d")).collect()
    assert [got[0].l, got[3].l, got[5].l] == [1.0, 1.0, 1.0] and 0.9 < got[1].l < 1 and got[2].l < 0.05 and got[4].l == 0 and got[7].l == 0
    assert got[0].a == got[0].b and list(got[1].d) == [17] and list(got[0].d) == [] and list(got[6].d) == [40]
    assert got[1].a[:64] != got[1].b[:64] and got[1].a.count("/") == 2 and got[1].a.count(".") == 37 and list(got[4].d) == [0]


# SimHash.


def test_simhash_bits():
    for t in (t for _, t in TEXTS):
        ws = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sh = [b" ".join(ws[i : i + 3]) for i in range(max(1, len(ws) - 2))] if ws else []
        h = [xxhash.xxh64_intdigest(x, 42) for x in sh]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.simhash(simhash.shingle_hashes(t or "")) & (2**64 - 1) == want


def groups_brute(prints, radius=2):
    parent = {p: p for p in prints}

    def top(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= radius:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {p: top(p) for p in prints}


def near_prints(seed, n):
    r = random.Random(seed)
    base = [r.getrandbits(64) for _ in range(12)]
    out = {0}
    while len(out) < n:
        p = r.choice(base)
        for _ in range(r.randint(0, 6)):
            p ^= 1 << r.randrange(64)
        out.add(p)
        base.append(p)
    return sorted(p - (1 << 64) if p >> 63 else p for p in out)


def test_bk_tree_finds_all():
    prints = [p & (2**64 - 1) for p in near_prints(1, 400)]
    tree = simhash.BKTree()
    for p in prints:
        tree.add(p)
    for p in prints[::7]:
        assert {tree.values[i] for i in tree.near(p, 2)} == {q for q in prints if (p ^ q).bit_count() <= 2}
    assert tree.near(5, -1) == [] and simhash.BKTree().near(5, 2) == []


@pytest.mark.parametrize("shard", [20_000, 3])
def test_components(spark, shard, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", shard)
    prints = near_prints(2, 500)
    df = spark.createDataFrame([(p,) for p in prints], "print long").repartition(4)
    got = {r.node: r.component for r in simhash.components(simhash.links(df)).collect()}
    want = groups_brute(prints)
    assert {p: got.get(p, p) for p in prints} == want and len(set(want.values())) < len(prints)


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(5, 5), (900, 901)], "a long, b long")
    got = {r.node: r.component for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 901: 900} and simhash.components(edges.limit(0)).count() == 0


def test_near_duplicates(docs, empty):
    rows = simhash.near_duplicates(docs).collect()
    prints = {t: simhash.simhash(simhash.shingle_hashes(t or "")) for _, t in TEXTS}
    roots = groups_brute(sorted(set(prints.values())))
    low = {}
    for i, t in TEXTS:
        if i is not None:
            low[roots[prints[t]]] = min(low.get(roots[prints[t]], i), i)
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == Counter((i, f"{prints[t] & (2**64 - 1):016x}", low.get(roots[prints[t]])) for i, t in TEXTS)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id for r in kept.collect() if r.doc_id is not None)) == sorted(set(low.values()))[:0] + sorted(low[g] for g in low)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_first(empty).count() == 0


# Quality.


def base_brute(t):
    t = t or ""
    x = split(t)
    c = Counter(zip(x, x[1:], x[2:]))
    hit = {k + j for k in range(len(x) - 2) if c[x[k], x[k + 1], x[k + 2]] > 1 for j in range(3)}
    ls = [l for l in t.split("\n") if l.encode().split()]
    return len(x), sum(len(w.decode()) for w in x), sum(ch in "#*$%&|<>" for ch in t), len(ls) - len(set(ls)), len(hit)


def test_quality_base(docs, empty):
    made = quality.references(docs)
    rows = quality.judge(docs, made).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == Counter((i, *base_brute(t)) for i, t in TEXTS)
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and (not r.base_failed or not r.kept)
    assert quality.judge(empty, made).count() == 0 and quality.references(empty)[0] == []
    assert all(r.kept != r.base_failed for r in quality.judge(docs, quality.references(empty)).collect())


def test_quality_references_and_distance(spark):
    r = random.Random(4)
    prose = [" ".join(r.choice(["the", "of", "and", "to", "house", "garden", "river", "walking"]) for _ in range(300)) + "." for _ in range(30)]
    junk = "### $$$ %%% | " * 100 + prose[0][:400]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(prose)] + [(99, junk, None)], "doc_id long, text string, lang string")
    langs, chars, common, ref = quality.references(df)
    c = Counter(w for t in prose for w in t.encode().split())
    assert langs == ["en"] and ref.sum() == sum(c.values()) and {w: int(n) for w, n in zip(common, ref[0], strict=False)} == c
    rows = {r.doc_id: r for r in quality.judge(df, (langs, chars, common, ref)).collect()}
    assert not rows[99].kept and rows[99].chars_distance > quality.FAR_CHARS and all(rows[i].words_distance < 0.2 for i in range(30))
    # Ordinary letters and spacing, but no common word of the language.
    odd = spark.createDataFrame([(1, " ".join(r.choice(["teh", "fo", "nda", "hosue", "gradne", "rievr"]) + r.choice("abcdefgh") for _ in range(300)) + "."), (2, " ".join(prose[0].split()[:60]))], "doc_id long, text string")
    made = {x.doc_id: x for x in quality.judge(odd, (langs, chars, common, ref)).collect()}
    assert not made[1].base_failed and not made[1].kept and made[1].chars_distance < quality.FAR_CHARS and made[2].words_distance is None
    p, q = np.array([[1.0, 0]]), np.array([[0.0, 1], [1, 0]])
    assert quality.js_distance(p, q).round(9).tolist() == [[1.0, 0.0]]


def test_quality_query_on_the_small_tables(spark):
    """The verdicts against labels, and the base columns against a brute-force version."""
    folder = "/root/testdata/sf0.01"
    rows = quality.op8_quality(spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    assert all((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base_brute(texts[r.doc_id]) for r in rows) and len(rows) == len(texts)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    judged = [r for r in rows if r.doc_id in labels and not r.base_failed and r.n_words >= quality.LEAST_WORDS]
    good, bad = [r.kept for r in judged if labels[r.doc_id]], [r.kept for r in judged if not labels[r.doc_id]]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.2 * len(bad) and len(bad) > 5


# Learned operators.


@pytest.fixture(scope="module")
def corpus(spark):
    r, rows, labels = random.Random(8), [], []
    bank = {"en": "the of and house river garden walking nothing people", "de": "der die und haus schön größer straße nicht über", "ru": "привет дом река сад люди ничего улица ночь"}
    sounds = {"en": "th er ing ou wh st ly", "de": "sch ei ä ung ü ß tz", "ru": "пр ив ок ст ень ша ту"}
    made = {x: ["".join(r.choice(s.split()) for _ in range(r.randint(2, 4))) for _ in range(300)] for x, s in sounds.items()}
    for i in range(1500):
        lang = r.choice(list(bank))
        text = [r.choice(bank[lang].split()) if r.random() < 0.4 else r.choice(made[lang]) for _ in range(r.randint(8, 60))]
        toxic = r.random() < 0.2
        if toxic:
            text[r.randrange(len(text))] = r.choice(["vilewort", "badding", "badness"])
        if r.random() < 0.6:
            labels.append((i, int(toxic)))
        rows.append((i, " ".join(text), lang, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, truth int"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_on_held_out_rows(spark, corpus, docs, empty):
    df, labels = corpus
    model = toxicity.train(df, labels)
    rows = toxicity.score(df, model).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(r.predicted == r.truth for r in held) / len(held) > 0.97 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    # Labels of held-out rows don't matter.
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.train(df, flipped)
    assert again.score("vilewort house") == model.score("vilewort house")
    odd = toxicity.score(docs, model)
    assert odd.count() == len(TEXTS) and set(odd.columns) == {*docs.columns, "held_out", "score", "predicted"} and odd.where("score IS NULL").count() == 0
    assert toxicity.score(empty, model).count() == 0 and toxicity.train(empty, labels.limit(0)).score("x") == 0.0
    nulls = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, toxic int")
    assert toxicity.train(docs, nulls).score("x") == 0.0
    assert toxicity.keep_clean(df, labels).columns == df.columns


def test_toxicity_query_on_the_small_tables(spark):
    """Held-out recall and false alarms, with labels that training may not see."""
    folder = "/root/testdata/sf0.1"
    rows = toxicity.op4_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for r in rows)
    toxic, clean = [r.predicted for r in rows if r.toxic], [r.predicted for r in rows if not r.toxic]
    assert sum(toxic) / len(toxic) >= 0.9 and sum(clean) / len(clean) < 0.005


def test_language_on_held_out_rows(corpus, docs, empty):
    df, _ = corpus
    model = language_id.train(df)
    rows = language_id.identify(df, model).collect()
    held = [r for r in rows if r.held_out]
    assert model.langs == ["de", "en", "ru"] and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    odd = {(r.doc_id, r.text): r for r in language_id.identify(docs, model).collect()}
    assert odd[6, None].lang_pred == "und" and odd[7, ""].lang_pred == "und" and odd[7, ""].score == 0 and all(0 <= r.score <= 1 for r in odd.values())
    assert language_id.identify(empty, model).count() == 0 and language_id.train(empty).predict(["x"]) == [("und", 0.0, [])]
    assert model.predict(["12 .. ??", "“”"])[0][0] == "und" and model.predict(["“”"])[0][0] == "und"


def test_language_spans(corpus):
    model = language_id.train(corpus[0])
    (lang, score, spans), = model.predict(["the house and river people walking nothing garden the of " * 2 + "der haus und straße nicht über schön größer die und " * 3 + "привет дом река сад"])
    assert [s["lang"] for s in spans] == ["en", "de", "ru"] and lang == "de" and 0.4 < score < 0.8 and sum(s["n_words"] for s in spans) == 54
    assert spans[1]["first_word"] == 20


def viterbi_brute(scores, switch):
    n, k = scores.shape
    best = np.full((n, k), -np.inf)
    best[0] = scores[0]
    for t in range(1, n):
        for j in range(k):
            best[t, j] = scores[t, j] + max(best[t - 1, i] - (switch if i != j else 0) for i in range(k))
    return best[-1].max()


def test_viterbi_is_best(corpus):
    model = language_id.train(corpus[0])
    r = random.Random(2)
    vocabulary = [w.encode() for w in "the of and haus straße привет дом nothing über xq zz".split()]
    docs_ = [[r.choice(vocabulary) for _ in range(r.randint(1, 12))] for _ in range(60)] + [[]]
    for own, path in zip(docs_, model.label(docs_), strict=True):
        if own:
            scores = np.array([model.rows[model.index[w]] for w in own], np.float64)
            value = scores[np.arange(len(own)), path].sum() - language_id.SWITCH * (path[1:] != path[:-1]).sum()
            assert abs(value - viterbi_brute(scores, language_id.SWITCH)) < 1e-2


@pytest.mark.parametrize("stretch", [1, 2, 3, 7])
def test_viterbi_in_stretches_is_best(corpus, monkeypatch, stretch):
    monkeypatch.setattr(language_id, "STRETCH", stretch)
    test_viterbi_is_best(corpus)


def test_pipeline_stages(spark, corpus, tmp_path):
    import corpus_pipeline

    df, labels = corpus
    df.drop("truth").withColumn("text", F.when(F.col("doc_id") % 50 == 0, F.concat("text", F.lit(" " + PASSAGE))).otherwise(F.col("text"))).write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs_, sizes = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    columns = docs_.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs_, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs_ = spark.read.parquet(str(tmp_path / name))
        sizes.append(docs_.count())
        assert name == "packing" or docs_.columns == columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "substring_dedup", "packing"]
    assert sizes[0] < 1500 and sizes[1] == sizes[0] >= sizes[2] == sizes[3]
    assert spark.read.parquet(str(tmp_path / "substring_dedup")).where(F.col("text").contains(PASSAGE)).count() == 0
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    whole = spark.read.parquet(str(tmp_path / "packing"))
    assert len(rows) == whole.count() and {r.doc_id for r in rows} == {r.doc_id for r in whole.collect()}


def test_lowest_ids_of_a_language(spark):
    """The training ids by a threshold are those of a whole ranking, for frequent and rare languages."""
    from eventide.llm import language_id

    usable = spark.range(5000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("lang"))
    hashed = [tuple(r) for r in usable.select("lang", F.xxhash64("doc_id"), "doc_id").collect()]
    for most in (3, 90, 1000, 50_000):
        want = {(x, d) for x in "ab" for _, _, d in sorted(r for r in hashed if r[0] == x)[:most]}
        assert {(r.lang, r.doc_id) for r in language_id.lowest(usable, most).collect()} == want
    assert language_id.lowest(usable.limit(0), 5).collect() == []
