"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the density of words and stems is trained with numpy
from confirmed toxic documents (P) and unlabelled ones (U). With class prior
``pi`` its risk is ``pi R_P(+) + max(0, R_U(-) - pi R_P(-))``: toxic documents
hidden in U are corrected for, and the estimate of the clean part can't go
below 0. A logistic curve over the labelled training rows turns its output
into a score.

A feature's value is its share of the document's words in percent, ``MOST`` at most:
what a clean text holds once by chance weighs little in it. Features are all
words and stems whose documents differ between P and U by ``STRENGTH``
standard errors, counted by presence or by repeated use; their number has no cap.

Training reads at most ``MAX_P`` toxic, ``MAX_N`` clean (for prior and curve
only) and ``MAX_U`` unlabelled documents, those of the lowest hashes of their
ids; equal word sets count once. They are hashed and counted by the executors;
the driver gets the chosen features, and their values in these documents only.
Scoring reads all texts whole.

* Labels are used only from rows whose crc32(doc_id as text) mod 3 is not 1.
  Labels, lang, source and doc_id aren't inputs of a score.
* A null text counts as an empty text; it gets the score of no words.
* A very long text is scored whole; its distinct words are held at once.
* Conflicting labels of a doc_id: toxic wins. Null labels are no labels.
* Without a toxic label in reach, all scores are 0. An empty table gives an
  empty result.
* Rows that repeat get equal scores. Other columns are kept; ``held_out``,
  ``score`` and ``predicted`` replace columns of those names.
"""

from __future__ import annotations

import hashlib
import string
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.llm.common import crc_mod, load, remove_path, shared_path

MAX_P, MAX_N, MAX_U = 3000, 3000, 6000
#: Prior where labels don't tell: they are all toxic.
PRIOR = 0.1
BITS, THRESHOLD = 20, 0.7
#: Standard errors by which a feature's documents differ, and toxic documents that have it, both at least.
STRENGTH, LEAST = 3.5, 3
#: Percent of the words from which a feature's value grows no more.
MOST = 2.0
#: Uses of a word, and share of the words, from which it counts as used repeatedly.
OFTEN, OFTEN_SHARE = 2, 0.004
#: Bytes of a word's beginning that count as its stem: inflected forms share them.
STEMS = (4, 5, 6)

_PLAIN = bytes.maketrans(string.punctuation.encode(), b" " * len(string.punctuation))


def _counted(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashed features of each distinct word, their uses, and the number of words: words, lower-cased and without ASCII punctuation, and their stems of ``STEMS`` bytes."""
    words = Counter((text or "").lower().encode("utf-8", "replace").translate(_PLAIN).split())
    uses = np.fromiter(words.values(), np.int64, len(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    found, counts = [np.fromiter(map(zlib.crc32, words), np.uint32, len(words))], [uses]
    for i, k in enumerate(STEMS, 1):
        longer = sizes > k
        stems = [w[:k] for w in words if len(w) > k]
        found.append(np.fromiter(map(zlib.crc32, stems), np.uint32, len(stems)) ^ np.uint32(0x9E3779B9 * i & 0xFFFFFFFF))
        counts.append(uses[longer])
    return (np.concatenate(found) >> np.uint32(32 - BITS)).astype(np.int32), np.concatenate(counts), int(uses.sum())


def _summed(hashed: np.ndarray, uses: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features, sorted, and the uses of each."""
    features, place = np.unique(hashed, return_inverse=True)
    return features, np.bincount(place, weights=uses, minlength=len(features))


def _value(uses: np.ndarray, n: int) -> np.ndarray:
    return np.minimum(100 * uses / max(n, 1), MOST)


@dataclass
class Model:
    features: np.ndarray  # hashed words
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def __post_init__(self):
        self.table = np.zeros(1 << BITS, np.float32)
        self.table[self.features] = self.weights

    def score(self, text: str | None) -> float:
        if not len(self.features):
            return 0.0
        hashed, uses, n = _counted(text)
        known = self.table[hashed] != 0
        features, uses = _summed(hashed[known], uses[known])
        z = self.bias + float((self.table[features].astype(np.float64) * _value(uses, n)).sum())
        return float(1 / (1 + np.exp(-np.clip(self.slope * z + self.shift, -500, 500))))


@dataclass
class Rows:
    """A sparse matrix: for each row its features and their values."""

    features: np.ndarray
    values: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
        join = lambda i, kind: np.concatenate([np.empty(0, kind), *(r[i] for r in rows)]).astype(kind)
        return cls(join(0, np.int64), join(1, np.float64), np.array([len(r[0]) for r in rows], np.int64))

    def times(self, w: np.ndarray) -> np.ndarray:
        upto = np.append(0.0, np.cumsum(w[self.features] * self.values))
        ends = np.cumsum(self.sizes)
        return upto[ends] - upto[ends - self.sizes]

    def transposed_times(self, g: np.ndarray, k: int) -> np.ndarray:
        return np.bincount(self.features, weights=self.values * np.repeat(g, self.sizes), minlength=k)


def nn_pu(p: Rows, u: Rows, prior: float, start: np.ndarray, rounds: int = 400, rate: float = 0.05, decay: float = 3e-5) -> tuple[np.ndarray, float]:
    """Weights and bias that lower the non-negative PU risk of the logistic loss over the rows of P and U; start: first weights."""
    k, n_p, n_u = len(start), max(1, len(p.sizes)), max(1, len(u.sizes))
    w, m, v = np.append(start, np.log(prior / (1 - prior))), np.zeros(k + 1), np.zeros(k + 1)
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    for t in range(1, rounds + 1):
        z_p, z_u = p.times(w[:-1]) + w[-1], u.times(w[:-1]) + w[-1]
        # The losses of rows taken as clean: of all, less those of toxic ones.
        if np.logaddexp(0, z_u).sum() / n_u - prior * np.logaddexp(0, z_p).sum() / n_p >= 0:
            g_p, g_u = np.full(len(z_p), -prior / n_p), sigmoid(z_u) / n_u  # of P both parts: s - 1 as toxic, less s as clean
        else:  # the clean part's estimate is below zero: step back from it
            g_p, g_u = prior / n_p * sigmoid(z_p), -sigmoid(z_u) / n_u
        grad = np.append(p.transposed_times(g_p, k) + u.transposed_times(g_u, k), g_p.sum() + g_u.sum()) + decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def curve(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, with Platt's targets and a small pull to slope 1."""
    p, n = y.sum(), (~y).sum()
    target = np.where(y, (p + 1) / (p + 2), 1 / (n + 2))
    a, b = 1.0, 0.0
    for _ in range(100):
        s = 1 / (1 + np.exp(-np.clip(a * z + b, -60, 60)))
        g = np.array([((s - target) * z).sum() + 0.01 * (a - 1), (s - target).sum() + 0.01 * b])
        r = s * (1 - s)
        h = np.array([[(r * z * z).sum() + 0.01, (r * z).sum()], [(r * z).sum(), r.sum() + 0.01]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 1e-3), float(b)


_ROWS = "kind string, doc_id long, digest binary, features binary, uses binary, n long"


def _hashed(batches):
    """A training row's features and uses, and a digest of the features."""
    for batch in batches:
        rows = []
        for text in batch.column(2).to_pylist():
            found, uses, n = _counted(text)
            features, uses = _summed(found, uses)
            raw = features.astype("<i4").tobytes()
            rows.append((hashlib.blake2b(raw, digest_size=16).digest(), raw, uses.astype("<i8").tobytes(), n))
        made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.binary(), pa.binary(), pa.binary(), pa.int64()))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["kind", "doc_id", "digest", "features", "uses", "n"])


def _unpacked(batch: pa.RecordBatch):
    """kind, doc_id, features, uses and words of each training row."""
    kinds, ids, features, uses, ns = (batch.column(c).to_pylist() for c in ("kind", "doc_id", "features", "uses", "n"))
    for kind, key, f, u, n in zip(kinds, ids, features, uses, ns, strict=True):
        yield kind, key, np.frombuffer(f, np.int32), np.frombuffer(u, np.int64), n


def _counts(batches):
    """How many rows have each feature, and how many use it repeatedly: of P, of all others."""
    counts = np.zeros((4, 1 << BITS), np.int32)
    for batch in batches:
        for kind, _, features, uses, n in _unpacked(batch):
            at = 0 if kind == "p" else 2
            counts[at, features] += 1
            counts[at + 1, features[(uses >= OFTEN) & (uses >= OFTEN_SHARE * n)]] += 1
    found = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), *(pa.array(c[found], pa.int64()) for c in counts)], names=["feature", "p_has", "p_often", "u_has", "u_often"])


def _chosen(features: np.ndarray):
    def run(batches):
        place = np.full(1 << BITS, -1, np.int32)
        place[features] = np.arange(len(features))
        for batch in batches:
            rows = []
            for kind, key, own, uses, n in _unpacked(batch):
                known = place[own] >= 0
                rows.append((kind, key, place[own[known]].astype("<i4").tobytes(), _value(uses[known], n).astype("<f8").tobytes()))
            made = [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.string(), pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(made, names=["kind", "doc_id", "features", "features_values"])

    return run


def fit(rows: DataFrame, prior: float) -> Model:
    """rows: kind (p, n or u), doc_id, digest, features, uses, n; of equal digests one counts."""
    none = Model(np.empty(0, np.int32), np.empty(0, np.float32), 0.0, 1.0, 0.0)
    once = rows.groupBy("kind", "digest").agg(F.min(F.struct("doc_id", "features", "uses", "n")).alias("x")).select("kind", "x.*")
    sizes = {r["kind"]: r["n"] for r in once.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    n_p, n_n, n_u = (sizes.get(k, 0) for k in "pnu")
    stand_in = n_u < 50  # too few without labels: clean ones stand in
    unlabelled = F.col("kind").isin(*("nu" if stand_in else "u"))
    n_all_u = n_u + stand_in * n_n
    if not n_p or not n_all_u:
        return none
    counted = once.where((F.col("kind") == "p") | unlabelled).mapInArrow(_counts, "feature long, p_has long, p_often long, u_has long, u_often long")
    sums = counted.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("p_has", "p_often", "u_has", "u_often")])

    def strength(how: str):
        """Difference of the logarithms of the shares in P and U, and how many standard errors that is."""
        p, u = F.col(f"p_{how}"), F.col(f"u_{how}")
        lift = F.log((p + 0.5) / (n_p + 1)) - F.log((u + 0.5) / (n_all_u + 1))
        return F.when(p >= LEAST, F.struct((lift / F.sqrt(1 / (p + 0.5) + 1 / (u + 0.5))).alias("strength"), lift.alias("lift")))

    best = sums.select("feature", F.greatest(strength("has"), strength("often")).alias("x")).where(F.col("x.strength") >= STRENGTH)
    chosen = best.select("feature", "x.lift").orderBy("feature").collect()
    features = np.array([r["feature"] for r in chosen], np.int32)
    if not len(features):
        return none
    by: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {k: [] for k in "pnu"}
    # A few chosen features for each of the bounded number of rows.
    for r in once.mapInArrow(_chosen(features), "kind string, doc_id long, features binary, features_values binary").orderBy("kind", "doc_id").collect():
        by[r["kind"]].append((np.frombuffer(r["features"], np.int32), np.frombuffer(r["features_values"], np.float64)))
    p, u, labelled = Rows.of(by["p"]), Rows.of(by["u"] + stand_in * by["n"]), Rows.of(by["p"] + by["n"])
    w, b = nn_pu(p, u, prior, np.array([r["lift"] for r in chosen]))
    slope, shift = curve(labelled.times(w) + b, np.arange(n_p + n_n) < n_p) if n_n else (1.0, 0.0)
    return Model(features, w.astype(np.float32), b, slope, shift)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the bounded samples."""
    spark = docs.sparkSession
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    usable = known.where(crc_mod(3) != 1).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = usable.agg(F.count_if(F.col("toxic") > 0).alias("p"), F.count_if(F.col("toxic") <= 0).alias("n")).first()
    prior = counts["p"] / (counts["p"] + counts["n"]) if counts["n"] else PRIOR
    keys = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id IS NOT NULL").where(crc_mod(3) != 1)
    lowest = lambda df, n: df.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    sample = (
        lowest(usable.where("toxic > 0").select("doc_id"), MAX_P).withColumn("kind", F.lit("p"))
        .unionByName(lowest(usable.where("toxic <= 0").select("doc_id"), MAX_N).withColumn("kind", F.lit("n")))
        .unionByName(lowest(keys.distinct().join(known, "doc_id", "left_anti"), MAX_U).withColumn("kind", F.lit("u")))
    )
    # The sample has a fixed bound of MAX_P + MAX_N + MAX_U ids.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id").select("kind", "doc_id", "text")
    path = shared_path(spark, "training")
    texts.mapInArrow(_hashed, _ROWS).write.parquet(path)
    model = fit(spark.read.schema(_ROWS).parquet(path), min(max(prior, 0.01), 0.5))
    remove_path(spark, path)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with held_out, score and predicted."""
    own = ["held_out", "score", "predicted"]
    docs = docs.drop(*own).withColumn("held_out", F.coalesce(crc_mod(3) == 1, F.lit(False)))
    arrays = (model.features, model.weights, model.bias, model.slope, model.shift)

    def run(batches):
        made = Model(*arrays)
        for batch in batches:
            scores = np.array([made.score(t) for t in batch.column("text").to_pylist()], np.float64)
            extra = [pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "score", "predicted"])

    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema] + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return docs.mapInArrow(run, schema)


def op4_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs, load(spark, sf_dir, "labels"))).select("doc_id", "held_out", "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs without those predicted toxic."""
    return score(docs, train(docs, labels)).where("predicted = 0").select(docs.columns)
