"""Quality rules by distribution divergence.

A document's histogram of character classes and its histogram of common words
are compared with those of each language by the Jensen-Shannon distance
(square root, base 2: 0 to 1). The verdict takes the nearest language of each;
documents too far from every language in either are rejected. Histograms of
too few characters or words aren't judged: too short to tell.

The references are made from all documents that have a lang: class counts, and
the ``COMMON`` most frequent words of each, whatever their length, all other
words being one more bin. A text without any common word has all its weight in
that bin; texts as far from all languages as that is from the nearest are too far.

Base rules: fewer than 50 words, or over half of the words in repeated 3-word
windows, fail at once.

* Words are ``[^\\x20\\x09-\\x0D]+``; a null text has none and fails.
* Without any lang there is no reference, and nothing is rejected for distance.
  An empty table gives an empty result.
* A very long text is counted whole. Word counts leave a task in parts of
  ``HELD`` words, and distances are taken for ``ROWS`` documents and one
  language at a time.
* Rows that repeat are counted as often in the references and get equal results.
* Other columns are kept; the operator's own replace columns of their names.
"""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import load

#: Common words of a language, and parts of its words that are ranked by themselves.
COMMON, PARTS = 60, 64
#: Different words that a task counts before they go out, and documents whose distances are taken at once.
HELD, ROWS = 300_000, 256
#: Least characters and words for a histogram to be judged.
LEAST_CHARS, LEAST_WORDS = 300, 100
#: Distance of the character classes above which a document is rejected.
FAR_CHARS = 0.26
SYMBOLS = "#*$%&|<>"

# Classes of bytes: lower case, upper case, digits, blanks, line ends, sentence marks, other ASCII, letters beyond ASCII (their first byte).
_CLASS = np.full(256, 6, np.uint8)
_CLASS[list(b"abcdefghijklmnopqrstuvwxyz")] = 0
_CLASS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
_CLASS[list(b"0123456789")] = 2
_CLASS[list(b" \t")] = 3
_CLASS[list(b"\n\r\x0b\x0c")] = 4
_CLASS[list(b".,;:!?'\"()-")] = 5
_CLASS[192:] = 7
_CLASS[128:192] = 8  # further bytes of a character: dropped
CLASSES = 8


def classes(raw: bytes) -> np.ndarray:
    return np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=9)[:CLASSES]


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distances of each row of counts p to each row of counts q, a row of q at a time."""
    p = p / np.maximum(p.sum(axis=1, keepdims=True), 1)
    q = q / np.maximum(q.sum(axis=1, keepdims=True), 1)
    out = np.zeros((len(p), len(q)))
    for i, own in enumerate(q):
        m = (p + own) / 2
        with np.errstate(divide="ignore", invalid="ignore"):
            part = lambda x: np.where(x > 0, x * np.log2(x / m), 0).sum(axis=1)  # noqa: B023, E731
            out[:, i] = np.sqrt(np.maximum((part(p) + part(own)) / 2, 0))
    return out


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that are found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    index = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(index.__getitem__, words), np.int64, n)
    two = ids[:-1] * len(index) + ids[1:]
    if len(index) >= 1 << 20:
        two = np.unique(two, return_inverse=True)[1]
    key = two[:-1] * len(index) + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    for at in (order[1:][same], order[:-1][same]):
        for k in range(3):
            hit[at + k] = True
    return int(hit.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line; they are cut at line feeds only."""
    lines = [x for x in text.encode("utf-8", "surrogatepass").split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def references(docs: DataFrame) -> tuple[list[str], np.ndarray, list[bytes], np.ndarray]:
    """Languages; class counts by language; common words; counts of these and of all others by language."""

    def rows(kind: str, langs: list[str], words: list[bytes | None], n: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array([kind] * len(n), pa.string()), pa.array(words, pa.binary()), pa.array(n, pa.int64())], names=["lang", "kind", "word", "n"])

    def count(batches):
        chars: dict[str, np.ndarray] = {}
        words: dict[str, Counter] = {}
        totals: Counter = Counter()

        def counted():
            for lang, c in words.items():
                yield rows("w", [lang] * len(c), list(c), list(c.values()))
            words.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                cut = raw.split()
                chars[lang] = chars.get(lang, 0) + classes(raw)
                words.setdefault(lang, Counter()).update(cut)
                totals[lang] += len(cut)
                if sum(map(len, words.values())) > HELD:
                    yield from counted()
        yield from counted()
        for i in range(CLASSES):
            yield rows(f"c{i}", list(chars), [None] * len(chars), [int(c[i]) for c in chars.values()])
        yield rows("t", list(totals), [None] * len(totals), list(totals.values()))

    texts = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    sums = texts.mapInArrow(count, "lang string, kind string, word binary, n long").groupBy("lang", "kind", "word").agg(F.sum("n").alias("n"))
    most = lambda df, *by: df.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "word"))).where(F.col("nth") <= COMMON)
    # Of each of a language's parts first, so that what is left to rank doesn't grow with the tasks.
    parts = most(sums.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(PARTS))), "lang", "kind", "part")
    rows = most(parts, "lang", "kind").collect()
    langs = sorted({r["lang"] for r in rows})
    at = {x: i for i, x in enumerate(langs)}
    common = sorted({bytes(r["word"]) for r in rows if r["kind"] == "w"})
    place = {w: i for i, w in enumerate(common)}
    chars, words = np.zeros((len(langs), CLASSES)), np.zeros((len(langs), len(common) + 1))
    for r in rows:
        if r["kind"] == "w":
            words[at[r["lang"]], place[bytes(r["word"])]] = r["n"]
        elif r["kind"] == "t":
            words[at[r["lang"]], -1] += r["n"]
        else:
            chars[at[r["lang"]], int(r["kind"][1:])] = r["n"]
    words[:, -1] -= words[:, :-1].sum(axis=1)
    return langs, chars, common, words


_OWN = [("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("base_failed", pa.bool_()), ("kept", pa.bool_()), ("chars_distance", pa.float64()), ("words_distance", pa.float64())]


def judge(docs: DataFrame, made: tuple) -> DataFrame:
    """docs with the counts of the base rules, base_failed, kept and both distances (null: not judged)."""
    docs = docs.drop(*[n for n, _ in _OWN])
    langs, chars, common, words_ref = made
    far_words = np.inf
    if langs and common:
        no_common_word = np.zeros((1, len(common) + 1))
        no_common_word[0, -1] = 1
        far_words = float(js_distance(no_common_word, words_ref).min()) - 1e-9

    def run(batches):
        place = {w: i for i, w in enumerate(common)}
        for batch in batches:
            texts, rows, d_chars, d_words = [t or "" for t in batch.column("text").to_pylist()], [], [], []
            for a in range(0, len(texts), ROWS):
                own = texts[a : a + ROWS]
                h_chars, h_words = np.zeros((len(own), CLASSES)), np.zeros((len(own), len(common) + 1))
                for i, text in enumerate(own):
                    raw = text.encode("utf-8", "surrogatepass")
                    cut = raw.split()
                    h_chars[i] = classes(raw)
                    # Words without a place fall into the last bin.
                    h_words[i] = np.bincount(np.fromiter(map(place.get, cut, repeat(len(common))), np.int64, len(cut)), minlength=len(common) + 1)
                    n, again = len(cut), repeat_words(cut)
                    length = len(b"".join(cut).decode("utf-8", "surrogatepass"))
                    rows.append((n, length, sum(map(text.count, SYMBOLS)), duplicate_lines(text), again, n < 50 or 100 * again > 50 * n))
                for out, h, ref, least in ((d_chars, h_chars, chars, LEAST_CHARS), (d_words, h_words, words_ref, LEAST_WORDS)):
                    out += np.where(h.sum(axis=1) >= least, js_distance(h, ref).min(axis=1) if langs else np.nan, np.nan).tolist()
            kept = [not r[5] and not (a > FAR_CHARS) and not (b >= far_words) for r, a, b in zip(rows, d_chars, d_words, strict=True)]
            made_columns = [[r[i] for r in rows] for i in range(6)] + [kept] + [[None if np.isnan(x) else x for x in d] for d in (d_chars, d_words)]
            extra = [pa.array(c, kind) for c, (_, kind) in zip(made_columns, _OWN, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *[n for n, _ in _OWN]])

    kinds = {pa.int64(): T.LongType(), pa.bool_(): T.BooleanType(), pa.float64(): T.DoubleType()}
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema] + [T.StructField(n, kinds[k]) for n, k in _OWN])
    return docs.mapInArrow(run, schema)


def op8_quality(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return judge(docs.select("doc_id", "text"), references(docs)).drop("text")
