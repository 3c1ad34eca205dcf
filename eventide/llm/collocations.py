"""Collocations: phrases whose words come together more often than their parts do.

All 1..max_n-grams of a language are exploded into rows and counted by hash
aggregation. Each candidate (2 words or more, found ``least`` times or more)
is joined with the counts of its first and last part for each cut, scored in
Decimal, held against its one-word extensions by an anti-join and ranked by a
window. A longer phrase that holds a candidate is never more frequent than the
one-word extension between the two, so extensions are enough for any length.

Most n-grams of a corpus are rare, and none of these decides anything: what is
asked for are candidates and their parts, all found ``least`` times. So n-grams
are first counted as 40-bit hashes, words, then pairs, then longer ones, each
only where both n-grams inside it that are one word shorter were found often
enough. The hashes found ``least`` times set bits of a filter of fixed size for
each length, and the n-grams that pass are exploded as strings and counted. A
filter that fills up lets rare n-grams pass, which the count of strings drops:
results are the same whatever passes.

* A null text counts as an empty one; a null lang is ``und``. Texts without a
  word add nothing; an empty table gives an empty result.
* A very long text is read in stretches of ``STRETCH`` bytes, cut between words.
* Rows that repeat count as often as they are there.
* Ties: cuts to the smallest first part, phrases to the higher count, then by bytes.
* Further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import load, mix64, salted_join, shared_path

#: Words of a phrase, least count of a candidate, percent of its count at which a longer one takes its place, phrases of a language.
MAX_N, LEAST, SHARE, TOP = 3, 10, 50, 2000
#: Bytes of text at once, hashes that a task sums before they go out, bits of the filter (a power of two).
STRETCH, HELD, BITS = 2 << 20, 2 << 20, 1 << 26
#: Bits of a hash that are counted, and the bit from which the filter's second place is taken.
COUNTED, SECOND = 40, 14
#: Texts that are joined at once.
TEXTS = 4000
#: Parts of a language that are ranked by themselves first.
PARTS = 64

#: A-Z to lower case, ends of pieces to full stops (which no word holds), tabs to blanks.
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + b",;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b"." * 9 + b" ")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def stretches(data: bytes, most: int):
    """data in parts of about ``most`` bytes that end before a blank or a full stop."""
    a = 0
    while a < len(data):
        b = a + most
        b = min((x for x in (data.find(b" ", b), data.find(b".", b)) if x >= 0), default=len(data)) if b < len(data) else len(data)
        yield data[a:b]
        a = b


class Grams:
    """The n-grams of a stretch. ``words`` begins with ``skip`` words of the stretch before it; n-grams of these alone were counted there."""

    def __init__(self, words: list[bytes], skip: int, lang: str, max_n: int):
        self.skip, self.max_n = skip, max_n
        place = {w: i for i, w in enumerate(dict.fromkeys(words))}
        self.distinct, self.dictionary = len(place), pa.array(list(place), pa.binary())
        self.ids = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        self.whole = self.ids != place.get(b".", -1)
        seed = xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))
        self.word_hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in place), np.uint64, len(place))

    def __iter__(self):
        """n, first positions, hashes by position, and which positions are new, for each n."""
        ok = self.whole
        h = hashes = self.word_hashes[self.ids]
        for n in range(1, self.max_n + 1):
            if n > 1:
                ok = ok[:-1] & self.whole[n - 1 :]
                h = mix64(h[:-1] * _ODD + hashes[n - 1 :])
            at = np.flatnonzero(ok)
            yield n, at, h, at + n > self.skip

    def counted(self, passes):
        """n, the phrases (binary) whose hash passes, and how often each is new here. A phrase passes only if the one without its last word does."""
        codes, good = self.ids, None
        for n, at, h, new in self:
            if n > 1:
                at, new = at[good[at]], new[good[at]]
                codes = codes[:-1] * self.distinct + self.ids[n - 1 :]
            ok = passes(n, h[at])
            at, new = at[ok], new[ok]
            if not len(at):
                return
            _, first, code = np.unique(codes[at], return_index=True, return_inverse=True)
            count = np.bincount(code[new], minlength=len(first))
            codes, good = np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
            codes[at], good[at] = code, True
            own = np.flatnonzero(count > 0)
            each = [self.dictionary.take(pa.array(self.ids[at[first[own]] + i])) for i in range(n)]
            yield n, each[0] if n == 1 else pc.binary_join_element_wise(*each, pa.scalar(b" ", pa.binary())), count[own]


def grams(batches, max_n: int):
    """lang and Grams of each stretch of the texts of a language in a batch."""
    for batch in batches:
        for a in range(0, batch.num_rows, TEXTS):
            part = batch.slice(a, TEXTS)
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if text:
                    by_lang.setdefault(lang, []).append(text.translate(_PLAIN))
            for lang, texts in by_lang.items():
                before: list[bytes] = []
                for data in stretches(b".".join(texts), STRETCH):
                    words = before + data.replace(b".", b" . ").split()
                    yield lang, Grams(words, len(before), lang, max_n)
                    before = words[len(words) - max_n + 1 :] if len(words) >= max_n else words


def texts_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").cast("binary").alias("text"))


def _passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    own = _counted_as(h)
    return np.logical_and.reduce([bits[b >> np.uint64(6)] >> (b & np.uint64(63)) & np.uint64(1) > 0 for b in (own & np.uint64(BITS - 1), own >> np.uint64(SECOND) & np.uint64(BITS - 1))])


def _counted_as(h: np.ndarray) -> np.ndarray:
    """What goes through the shuffle for a hash: fewer bits, of which most rows consist."""
    return h >> np.uint64(64 - COUNTED)


def frequent_bits(texts: DataFrame, size: int, shorter: Broadcast | None, least: int) -> np.ndarray:
    """A filter with the bits of all hashes of ``size``-grams that are found ``least`` times; ``shorter``: the filter of those one word shorter."""

    def hashed(batches):
        held, n_held = [], 0

        def out():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            for a in range(0, len(h), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(h[a : a + (1 << 17)].view(np.int64)), pa.array(n[a : a + (1 << 17)])], names=["h", "n"])

        for _, own in grams(batches, size):
            if size == 1:
                n = np.bincount(own.ids[own.skip :][own.whole[own.skip :]], minlength=own.distinct)
                yield pa.RecordBatch.from_arrays([pa.array(_counted_as(own.word_hashes[n > 0]).view(np.int64)), pa.array(n[n > 0])], names=["h", "n"])
                continue
            good = None
            for n, at, h, new in own:
                if n == size:
                    held.append(_counted_as(h[at[new & good[at] & good[at + 1]]]))
                    n_held += len(held[-1])
                elif n == size - 1:
                    good = _passes(shorter.value, h)
            if n_held > HELD:
                yield from out()
                held, n_held = [], 0
        if n_held:
            yield from out()

    often = texts.mapInArrow(hashed, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    places = F.array(F.col("h").bitwiseAND(BITS - 1), F.shiftrightunsigned("h", SECOND).bitwiseAND(BITS - 1))
    words = often.select(F.explode(places).alias("b")).groupBy(F.shiftright("b", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(b & 63 AS int)))").alias("bits"))
    # A row for each 64 bits of the filter at most, whatever the corpus.
    found, out = words.toArrow(), np.zeros(BITS // 64, np.uint64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


def counts(docs: DataFrame, max_n: int, least: int) -> DataFrame:
    """lang, phrase, words and f of all phrases found ``least`` times; the phrase is null for a language's number of words."""
    texts, context, filters = texts_of(docs), docs.sparkSession.sparkContext, []
    for n in range(1, max_n + 1):
        filters.append(context.broadcast(frequent_bits(texts, n, filters[-1] if filters else None, least)))

    def exploded(batches):
        bits = [f.value for f in filters]

        def rows(lang: str, n: int, phrases: pa.Array, f) -> pa.RecordBatch:
            same = [pa.repeat(pa.scalar(v, kind), len(phrases)) for v, kind in ((lang, pa.string()), (n, pa.int32()))]
            return pa.RecordBatch.from_arrays([same[0], phrases, same[1], pa.array(f, pa.int64())], names=["lang", "phrase", "words", "f"])

        for lang, own in grams(batches, max_n):
            yield rows(lang, 0, pa.array([None], pa.binary()), [int(own.whole[own.skip :].sum())])
            for n, phrases, f in own.counted(lambda n, h: _passes(bits[n - 1], h)):
                yield rows(lang, n, phrases, f)

    rows = texts.mapInArrow(exploded, "lang string, phrase binary, words int, f long").groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return rows.where((F.col("f") >= least) | F.col("phrase").isNull()).withColumn("phrase", F.col("phrase").cast("string"))


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def scored(known: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r and score of each candidate, for the cut with the lowest score."""
    words = F.split("phrase", " ")
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.col("words") - 1), lambda k: F.struct(k.alias("k"), _part(words, F.lit(1), k).alias("first"), _part(words, k + 1, F.col("words") - k).alias("rest"))))
    cuts = known.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), cut.alias("c"))
    cuts = cuts.select("lang", "phrase", "words", "a", "c.k", F.struct("lang", F.col("c.first").alias("phrase")).alias("left"), F.struct("lang", F.col("c.rest").alias("phrase")).alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        # A part is in at most a ``least``-th as many candidates as it is found: the most frequent are those that may be hot.
        by = known.select(F.struct("lang", "phrase").alias(side), F.col("f").alias(name), F.col("f").alias("n"))
        cuts = salted_join(cuts, by, side, "inner", ["phrase", "k"])
    whole = lambda name, digits: F.col(name).cast(f"decimal({digits},0)")
    cuts = cuts.withColumn("above", F.lit(1_000_000).cast("decimal(7,0)") * whole("a", 15) * whole("a", 15)).withColumn("below", whole("l", 18) * whole("r", 18))
    lowest = F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r"))
    return cuts.groupBy("lang", "phrase", "words", "a").agg(lowest.alias("c")).select("lang", "phrase", "words", "a", "c.l", "c.r", "c.score")


def without_extended(found: DataFrame, known: DataFrame, share: int) -> DataFrame:
    """Candidates that no one-word extension with ``share`` percent of their count holds."""
    words = F.split("phrase", " ")
    inner = F.explode(F.array(_part(words, F.lit(1), F.col("words") - 1), _part(words, F.lit(2), F.col("words") - 1)))
    longer = known.where("words > 2").select("lang", inner.alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    longer = longer.select(F.col("lang").alias("in_lang"), F.col("phrase").alias("part"), "longer")
    held = (F.col("lang") == F.col("in_lang")) & (F.col("phrase") == F.col("part")) & (100 * F.col("longer") >= share * F.col("a"))
    return found.join(longer, held, "left_anti")


def best(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language with their rank: of each of its parts first, then of these."""
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    parts = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    keep = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    return keep(keep(parts, "lang", "part").drop("rank", "part"), "lang")


def collocations(docs: DataFrame, max_n: int = MAX_N, least: int = LEAST, share: int = SHARE, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` phrases of each language."""
    spark, path = docs.sparkSession, shared_path(docs.sparkSession, "phrases")
    # Counted once, read by all that follows.
    counts(docs, max_n, least).write.parquet(path)
    counted = spark.read.parquet(path)
    known, total = counted.where("phrase IS NOT NULL"), counted.where("phrase IS NULL").select("lang", F.col("f").alias("n"))
    out = best(without_extended(scored(known), known, share), top).join(total, "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(load(spark, sf_dir, "documents").select("lang", "text"))


def _sql(max_n: int, least: int, share: int, top: int) -> str:
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    joined = lambda n: " || ' ' || ".join(f"ws[i + {j}]" if j else "ws[i]" for j in range(n))
    lists = ", ".join(f"SELECT lang, {n} AS words, unnest([{joined(n)} FOR i IN range(1, len(ws) - {n - 2})]) AS phrase FROM w WHERE len(ws) >= {n}" for n in range(1, max_n + 1))
    lists = lists.replace(", SELECT lang", " UNION ALL SELECT lang")
    cuts = " UNION ALL ".join(f"SELECT lang, phrase, words, f AS a, {k} AS k, array_to_string(string_split(phrase, ' ')[1:{k}], ' ') AS head, array_to_string(string_split(phrase, ' ')[{k + 1}:], ' ') AS tail FROM c WHERE words > {k}" for k in range(1, max_n))
    inner = " UNION ALL ".join(f"SELECT lang, f, array_to_string(string_split(phrase, ' ')[{i}:{i + n - 1}], ' ') AS part FROM c WHERE words = {m}" for m in range(3, max_n + 1) for n in range(2, m) for i in range(1, m - n + 2))
    return f"""
WITH w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]'), lambda x: x <> '') AS ws FROM (
       SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, '{upper}', '{lower}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents WHERE text IS NOT NULL)),
     g AS ({lists}),
     c AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {least}),
     t AS (SELECT lang, count(*) AS n FROM g WHERE words = 1 GROUP BY lang),
     s AS (SELECT x.lang, x.phrase, x.words, x.a, x.k, h.f AS l, e.f AS r, (1000000::HUGEINT * x.a * x.a) // (h.f::HUGEINT * e.f) AS score
           FROM ({cuts}) x JOIN c h ON h.lang = x.lang AND h.phrase = x.head JOIN c e ON e.lang = x.lang AND e.phrase = x.tail),
     b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
     e AS (SELECT lang, part, max(f) AS longer FROM ({inner}) GROUP BY lang, part),
     d AS (SELECT b.* FROM b LEFT JOIN e ON e.lang = b.lang AND e.part = b.phrase WHERE e.longer IS NULL OR 100 * e.longer < {share} * b.a)
SELECT d.lang, row_number() OVER (PARTITION BY d.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM d JOIN t ON t.lang = d.lang QUALIFY rank <= {top}
"""


SQL = _sql(MAX_N, LEAST, SHARE, TOP)
