"""Line dedup by winnowing, in DataFrame operations only.

Each line is hashed. Of every ``window`` consecutive lines the smallest hash
(the leftmost of equals) is the window's fingerprint: two equal windows pick
the same line, so a repeated run of ``window`` lines is guaranteed to share
one. Positions of equal fingerprints are joined through a row for each
fingerprint, never in pairs; those that stand alone go no further. A match is
extended both ways by the windows that reach from its fingerprint to either
side: each is joined with the first place of the same lines behind the same
fingerprint. Overlapping matches are maximal runs, and every run is deleted
where it occurs later.

The most frequent fingerprints, and windows, are known to all tasks, and
their rows are salted: no line, however common, meets in one task.

Order: doc_id (null first), then the row's text hash, then the line number.

* A null text counts as an empty text; an empty text is one empty line. Lines
  are what stands between line feeds, so runs of empty lines are runs as well.
* Texts of fewer lines than ``window`` are never changed, unless ``words`` is
  given: then repeated runs of fewer lines, one line included, go where they
  have at least that many words (``[^\\x20\\x09-\\x0D]+``) together.
* Very long texts are taken whole: a row for each window, and one array of the
  text's lines. An empty table gives an empty result.
* Rows that repeat both doc_id and text count once and get the same result.
* Columns beside doc_id and text are kept; ``n_lines`` and ``n_removed`` are
  the operator's own and replace columns of those names. Names used inside
  yield to those of the frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import let, load, row_key, salted_join, spare, text_or_empty

#: Lines a repeated run has at least.
WINDOW = 3
#: Columns that tell windows apart.
PLACE = ["doc_id", "_rid", "i"]
WORD = r"[^\x20\x09-\x0D]+"


def _windows(docs: DataFrame, window: int, words: int | None = None) -> DataFrame:
    """A row for every window (with ``words``, also for shorter ones of that many words): its place, its fingerprint with the fingerprint's place, and its line hashes."""
    split = F.split(text_or_empty(), "\n")
    least = window if words is None else 1
    counts = [] if words is None else [F.transform(split, lambda x: F.regexp_count(x, F.lit(WORD))).alias("_n")]
    lines = docs.select("doc_id", row_key().alias("_rid"), F.transform(split, lambda x: F.xxhash64(x)).alias("_lh"), *counts).where(F.size("_lh") >= least)

    def of(k: int) -> Column:
        """The windows of k lines."""

        def at(i):
            part = F.slice(F.col("_lh"), i + 1, k)
            low = F.array_min(part)
            # Windows of different lengths don't meet, so their fingerprints differ as well.
            return F.struct(i.alias("i"), (low if k == window else F.xxhash64(low, F.lit(k))).alias("fp"), (i + F.array_position(part, low).cast("int")).alias("p"), part.alias("key"))

        def wordy(i):
            # A window both of whose ends can go needs no row: without the end, the rest is such a window too.
            n, last = F.aggregate(F.slice("_n", i + 1, k), F.lit(0), lambda a, x: a + x), i + (k - 1)
            return (n >= words) & ((n - F.get("_n", i) < words) | (n - F.get("_n", last) < words))

        places = F.sequence(F.lit(0), F.size("_lh") - k)
        if k > least:
            places = F.when(F.size("_lh") >= k, places).otherwise(F.array().cast("array<int>"))
        return F.transform(places if k == window else F.filter(places, wordy), at)

    found = F.concat(*map(of, range(least, window + 1))) if least < window else of(window)
    return lines.select("doc_id", "_rid", F.explode(found).alias("w")).select("doc_id", "_rid", "w.*")


def later_windows(docs: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """doc_id, _rid, i and number of lines k of every window whose lines also start at an earlier place."""
    windows = _windows(docs.select("doc_id", "text"), window, words)
    matched = windows
    if window > 1:  # a window of one line is its own fingerprint
        place = F.xxhash64("doc_id", "_rid", "p")
        # Fingerprints are counted before the shuffle; a hot one leaves each task as a single row.
        repeated = windows.groupBy("fp").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.count("*").alias("n")).where("a <> b").select("fp", "n")
        matched = salted_join(windows, repeated, "fp", "left_semi", PLACE)
    here = F.struct("doc_id", "_rid", "i")
    first = matched.groupBy("key").agg(F.min(here).alias("first"), F.max(here).alias("last"), F.count("*").alias("n")).where("first < last").select("key", "first", "n")
    return salted_join(matched, first, "key", "inner", PLACE).where(here > F.col("first")).select("doc_id", "_rid", "i", F.size("key").alias("k"))


def _kept(lines: Column, gone: Column) -> Column:
    """The lines but those of the given numbers."""
    return let(lines, lambda ls: F.transform(F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), gone), lambda i: F.get(ls, i)))


def dedup_lines(docs: DataFrame, window: int = WINDOW, words: int | None = None) -> DataFrame:
    """docs with the repeated runs of lines removed from text, plus n_lines and n_removed; with ``words``, shorter runs of that many words also go."""
    docs = docs.drop("n_lines", "n_removed")
    # Windows of all lengths go through one plan: the driver pays for a plan, not for rows.
    later = later_windows(docs, window, words).select("doc_id", "_rid", F.sequence(F.col("i"), F.col("i") + F.col("k") - 1).alias("run"))
    rid, gone, hit_id, hit_rid = spare(docs, "rid", "gone", "hit_id", "hit_rid")
    hits = later.groupBy("doc_id", "_rid").agg(F.array_distinct(F.flatten(F.collect_list("run"))).alias(gone)).withColumnsRenamed({"doc_id": hit_id, "_rid": hit_rid})
    own = docs.withColumn(rid, row_key())
    joined = own.join(hits, (F.col(rid) == F.col(hit_rid)) & F.col("doc_id").eqNullSafe(F.col(hit_id)), "left")
    lines = F.split(text_or_empty(), "\n")
    return (
        joined.withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_removed", F.coalesce(F.size(gone), F.lit(0)).cast("long"))
        .withColumn("text", F.when(F.col(gone).isNull(), F.col("text")).otherwise(F.array_join(_kept(lines, F.col(gone)), "\n")))
        .drop(rid, hit_id, hit_rid, gone)
    )


def op1_line_dedup(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(load(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(text_or_empty(), 256).alias("kept_sha256"))


SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents
), w AS (
  SELECT doc_id, i, list(line) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS lines
  FROM l
), f AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY lines ORDER BY doc_id, i) AS nth FROM w WHERE len(lines) = {WINDOW}
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(range({WINDOW})) AS i FROM f WHERE nth > 1
)
SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN gone.i IS NULL THEN l.line END, chr(10) ORDER BY l.i), '')) AS kept_sha256
FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i
GROUP BY l.doc_id
"""
