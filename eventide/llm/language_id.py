"""Language ID: script ranges narrow the candidates, then Viterbi over words labels spans of mixed text.

A word is a run of letters (ASCII ones, or any bytes beyond ASCII),
lower-cased. Its score in a language is the sum of log probabilities of its
byte trigrams, marks at both ends included. The script of its first letter
leaves as candidates the languages that use the script in training; a script
that none uses says nothing. Along the words of a document the best path pays
``SWITCH`` for each change of language; its runs are the labelled spans. The
document's language is the one whose spans hold most letters (bytes), its
score their share.

Training takes at most ``PER_LANG`` documents of each language, those of the
lowest hashes of their ids, and only documents with a lang whose
crc32(doc_id as text) mod 4 is not 2. Prediction reads all texts whole.

* lang, source and doc_id aren't inputs of a prediction.
* Null texts and texts without a letter: ``und``, score 0, no spans; likewise
  all texts where nothing could be learned.
* Rows that repeat get equal results. Ties go to the first language by name.
* Very long texts are labelled whole, in stretches side by side. An empty
  table gives an empty result.
* Other columns are kept; ``held_out``, ``lang_pred``, ``score`` and ``spans``
  replace columns of those names.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.byte_bpe import slices
from eventide.llm.common import crc_mod, load

#: Documents of a language; up to 1000 of them Spark takes from each task before it shuffles.
PER_LANG, SWITCH, BITS, KEPT = 1000, 12.0, 16, 100_000
#: Words of a document that are labelled one after the other; stretches of longer ones go side by side.
STRETCH = 1024
#: Least share of a language's training words in a script for it to be a candidate.
SHARE = 0.01
#: What a language that isn't a candidate scores below the best.
OUT = -40.0

# Blocks of the Unicode standard.
SCRIPTS = [
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("thai", 0x0E00, 0x0E7F), ("georgian", 0x10A0, 0x10FF), ("latin", 0x1E00, 0x1EFF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7AF),
]
NAMES = sorted({name for name, _, _ in SCRIPTS}) + ["other"]

_LETTERS = bytes(b if chr(b) in string.ascii_lowercase or b >= 128 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_LETTERS).split()


def has_letter(text: str | None, words: list[bytes]) -> bool:
    return bool(words) and (any(w[0] < 128 for w in words) or any(map(str.isalpha, text)))


def script_of(word: bytes) -> int:
    if word[0] < 128:
        return NAMES.index("latin")
    c = ord(word.decode("utf-8", "replace")[0])
    return NAMES.index(next((name for name, a, z in SCRIPTS if a <= c <= z), "other"))


def trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of words with a mark at both ends, and where each word's begin."""
    raw = np.frombuffer(b"".join(b"^" + w + b"$" for w in words), np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    code = raw[:-2] << np.uint32(16) | raw[1:-1] << np.uint32(8) | raw[2:]
    hashed = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    begin = np.cumsum(sizes + 2) - (sizes + 2)
    inside = np.ones(len(hashed), bool)  # trigrams that go over the end of a word don't count
    for back in (1, 2):
        inside[begin[1:] - back] = False
    return hashed[inside], np.append(0, np.cumsum(sizes))[:-1]


class Model:
    def __init__(self, langs: list[str], logs: np.ndarray, scripts: np.ndarray):
        """logs: trigrams by languages; scripts: scripts by languages, whether the language is a candidate."""
        self.langs, self.logs, self.scripts = langs, logs, scripts
        self.clear()

    def clear(self):
        self.index: dict[bytes, int] = {}
        self.rows = np.zeros((0, len(self.langs)), np.float32)

    def _word_scores(self, words: list[bytes]) -> np.ndarray:
        grams, begin = trigrams(words)
        scores = np.add.reduceat(self.logs[grams], begin, axis=0)
        candidates = self.scripts[[script_of(w) for w in words]]
        scores = np.where(candidates, scores, -np.inf)
        best = scores.max(axis=1, keepdims=True)
        scores = np.maximum(scores - np.where(np.isfinite(best), best, 0), OUT)
        scores[~candidates.any(axis=1)] = 0
        return scores.astype(np.float32)

    def learn(self, words: set[bytes]) -> None:
        new = words - self.index.keys()
        if len(self.index) + len(new) > KEPT:
            self.clear()
            new = words
        if new:
            new = sorted(new)
            self.index.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            self.rows = np.concatenate([self.rows, self._word_scores(new)])

    def _forward(self, flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray, entry: np.ndarray, end: np.ndarray | None) -> np.ndarray:
        """Viterbi over stretches of flat, one word further in all of them together, the longest first, so those that go on always lead.

        entry: what each language costs at a stretch's first word. Without
        ``end``, the value of the best path to each language at the last word;
        with it (-1: the best), the path of each stretch, one behind the other.
        """
        order = np.argsort(-sizes, kind="stable")
        back = np.argsort(order)
        start, own_sizes = begin[order], sizes[order]
        longest = int(sizes.max()) if len(sizes) else 0
        active = np.append(np.searchsorted(-own_sizes, -np.arange(1, longest + 1), side="right"), 0)
        state, total = entry[order].astype(np.float32), np.zeros(len(sizes))
        changed, sources, final = [], [], np.zeros((len(sizes), len(self.langs)))
        for t in range(longest):
            n = active[t]
            own = self.rows[flat[start[:n] + t]]
            state = state[:n]
            if t:
                source = state.argmax(axis=1)
                best = state[np.arange(n), source][:, None] - np.float32(SWITCH)
                if end is not None:
                    changed.append(best > state)
                    sources.append(source.astype(np.int16))
                state = np.maximum(best, state)
            state = state + own
            # Only differences matter; so sums stay small.
            top = state.max(axis=1, keepdims=True)
            state, total[:n] = state - top, total[:n] + top[:, 0]
            last = slice(active[t + 1], n)
            final[last] = state[last] + total[last, None]
        if end is None:
            return final[back]
        forced = end[order]
        here = np.where(forced < 0, final.argmax(axis=1) if len(final) else 0, forced)
        out = np.zeros((int(sizes.sum()),), np.int16)
        into = (np.cumsum(sizes) - sizes)[order]
        for t in range(longest - 1, -1, -1):
            n = active[t]
            out[into[:n] + t] = here[:n]
            if t:
                here[:n] = np.where(changed[t - 1][np.arange(n), here[:n]], sources[t - 1], here[:n])
        return out

    def label(self, docs: list[list[bytes]]) -> list[np.ndarray]:
        """The language (index) of each word of each document: the best path.

        Long documents are cut into stretches. The best value from each language
        before a stretch to each at its end is found for all stretches side by
        side; chained up, these tell where the best path enters and leaves each.
        """
        k = len(self.langs)
        self.learn(set().union(*docs))
        sizes = np.array([len(d) for d in docs], np.int64)
        flat = np.fromiter((i for d in docs for i in map(self.index.__getitem__, d)), np.int64, int(sizes.sum()))
        parts = -(-sizes // STRETCH)
        owner = np.repeat(np.arange(len(docs)), parts)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = (np.cumsum(sizes) - sizes)[owner] + nth * STRETCH
        length = np.minimum(sizes[owner] - nth * STRETCH, STRETCH)
        entry, end = np.zeros((len(owner), k), np.float32), np.full(len(owner), -1)
        inner = np.flatnonzero(parts[owner] > 1)
        if len(inner):
            # Coming from language i costs SWITCH for all others; the first stretch of a document comes from none.
            costs = np.where(np.eye(k, dtype=bool), 0, -SWITCH).astype(np.float32)
            each = np.where((nth[inner] == 0)[:, None, None], np.float32(0), costs[None])
            over = self._forward(flat, np.repeat(begin[inner], k), np.repeat(length[inner], k), each.reshape(-1, k), None).reshape(-1, k, k)
            for d in np.unique(owner[inner]):
                own = np.flatnonzero(owner[inner] == d)
                value, came = over[own[0]][0], []
                for at in own[1:]:
                    way = value[:, None] + over[at]
                    came.append(way.argmax(axis=0))
                    value = way.max(axis=0)
                here = int(value.argmax())
                for at, source in zip(own[:0:-1], came[::-1], strict=True):
                    end[inner[at]] = here
                    here = int(source[here])
                    entry[inner[at]] = costs[here]
                end[inner[own[0]]] = here
        path = self._forward(flat, begin, length, entry, end)
        return np.split(path, np.cumsum(sizes)[:-1]) if len(docs) else []

    def predict(self, texts: list[str | None]) -> list[tuple[str, float, list[dict]]]:
        """lang_pred, score and spans of each text."""
        if not self.langs:
            return [("und", 0.0, [])] * len(texts)
        words = [words_of(t) if t else [] for t in texts]
        words = [w if has_letter(t, w) else [] for t, w in zip(texts, words, strict=True)]
        out = []
        for own, path in zip(words, self.label(words), strict=True):
            if not own:
                out.append(("und", 0.0, []))
                continue
            letters = np.bincount(path, weights=np.fromiter(map(len, own), np.int64, len(own)), minlength=len(self.langs))
            top = int(letters.argmax())
            starts = np.flatnonzero(np.append(True, path[1:] != path[:-1]))
            spans = [{"first_word": int(a), "n_words": int(z - a), "lang": self.langs[path[a]]} for a, z in zip(starts, np.append(starts[1:], len(path)), strict=True)]
            out.append((self.langs[top], float(letters[top] / letters.sum()), spans))
        return out


def lowest(usable: DataFrame, most: int) -> DataFrame:
    """The ``most`` rows of each language with the lowest hashes of doc_id.

    A language's count says below which hash about twice as many lie, so a
    frequent language leaves no more rows to be ranked than a rare one. Should
    too few lie there in any language, all rows are ranked.
    """
    h = F.xxhash64("doc_id")
    # A row for each language, as the model has.
    n = usable.groupBy("lang").agg(F.count("*").alias("n"))
    at = h.cast("double") / 2.0**64 + 0.5
    near = usable.join(F.broadcast(n), "lang").where(at <= F.least(F.lit(1.0), F.lit(2.0 * most) / F.col("n")))
    short = near.groupBy("lang").agg(F.count("*").alias("near"), F.first("n").alias("n")).join(n.select("lang"), "lang", "right").where(F.coalesce("near", F.lit(0)) < F.least("n", F.lit(most)))
    rows = near.drop("n") if short.isEmpty() else usable
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(h, "doc_id"))
    return rows.withColumn("nth", nth).where(F.col("nth") <= most).drop("nth")


def train(docs: DataFrame) -> Model:
    """Fit on the bounded sample; the driver gets counts for each language only."""
    usable = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang")).where("doc_id IS NOT NULL AND lang IS NOT NULL").where(crc_mod(4) != 2)
    sample = lowest(usable, PER_LANG)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").alias("own"), F.col("text").cast("string").alias("text"))
    # A bounded number of ids for each language; the texts are gathered in few partitions, so few counts go to the driver.
    chosen = texts.join(F.broadcast(sample), "doc_id").where("lang = own").select("lang", "text").repartition(8)

    def count(batches):
        grams: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text or "")
                if has_letter(text, words):
                    own = grams.setdefault(lang, np.zeros((1 << BITS) + len(NAMES), np.int64))
                    own[: 1 << BITS] += np.bincount(trigrams(words)[0], minlength=1 << BITS)
                    own[1 << BITS :] += np.bincount([script_of(w) for w in words], minlength=len(NAMES))
        yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array([g.tobytes() for g in grams.values()], pa.binary())], names=["lang", "counts"])

    totals: dict[str, np.ndarray] = {}
    for row in chosen.mapInArrow(count, "lang string, counts binary").toLocalIterator():
        totals[row["lang"]] = totals.get(row["lang"], 0) + np.frombuffer(row["counts"], np.int64)
    langs = sorted(totals)
    if not langs:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros((len(NAMES), 0), bool))
    grams = np.stack([totals[x][: 1 << BITS] for x in langs], axis=1) + 0.1
    scripts = np.stack([totals[x][1 << BITS :] for x in langs], axis=1)
    return Model(langs, np.log(grams / grams.sum(axis=0)).astype(np.float32), scripts >= SHARE * np.maximum(scripts.sum(axis=0), 1))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """docs with held_out, lang_pred, score and spans (first_word and n_words count words of letters)."""
    docs = docs.drop("held_out", "lang_pred", "score", "spans").withColumn("held_out", F.coalesce(crc_mod(4) == 2, F.lit(False)))
    parts = (model.langs, model.logs, model.scripts)
    span = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))

    def run(batches):
        made = Model(*parts)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for a, z in slices([t or "" for t in texts]):
                found = made.predict(texts[a:z])
                extra = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()), pa.array([f[2] for f in found], span)]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, z - a).columns, *extra], names=[*batch.schema.names, "lang_pred", "score", "spans"])

    kind = T.ArrayType(T.StructType([T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("lang", T.StringType())]))
    added = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("spans", kind)]
    return docs.mapInArrow(run, T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema] + added))


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), train(docs)).select("doc_id", "held_out", "lang_pred", "score", "spans")
