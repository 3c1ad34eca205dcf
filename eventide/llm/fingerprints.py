"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections, in DataFrame operations only.

A paragraph is a line; a section is a run of ``SECTION`` paragraphs. Leaves
are the pieces of up to ``PIECE`` code points that a paragraph is cut into
from its start. A leaf's digest is its SHA-256; a paragraph's is that of its
leaves' digests, a section's that of its paragraphs', the root that of the
sections'.

``fingerprint`` is ``root:section/section/...`` with a section written as
``digest=paragraph.paragraph...`` and a paragraph as its digest followed by
those of its leaves. The root is whole (64 hexadecimal digits), all others are
their first 8 digits. Roots test equality; branches that differ locate edits
(:func:`differing`) and tell the likeness of two fingerprints
(:func:`likeness`), from the sections down: what is below equal branches isn't
looked at. The string grows with the text, by 8 digits for each ``PIECE`` code
points: only so an edit can be located from two fingerprints alone.

* A null text counts as an empty text: one empty paragraph without leaves.
* Equal texts, repeated rows included, have equal fingerprints.
* The next document of rows with one doc_id is the next of them by text. A
  single row is its own next; an empty table gives an empty result.
* Nulls in doc_id stand before all others.
* Very long texts are hashed whole, in their row.
* Other columns are kept by :func:`with_next`, whose own names yield to theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.llm.common import let, load, partitions, spare, text_or_empty

PIECE = 32
SECTION = 16
LEAST = -(1 << 63)
#: Ranges of doc_id at most; each is sorted by itself, on disk where it must be, so the driver's list of bounds stays small whatever the table.
RANGES = 1 << 16


def fingerprint(text: Column) -> Column:
    """The fingerprint as a string."""
    short = lambda h: F.substring(h, 1, 8)
    digest = lambda parts: F.sha2(F.array_join(parts, ""), 256)

    def paragraph(p: Column) -> Column:
        pieces = F.regexp_extract_all(p, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
        leaves = F.transform(pieces, lambda x: F.sha2(x, 256))
        return let(leaves, lambda ls: F.struct(digest(ls).alias("h"), F.array_join(F.transform(ls, short), "").alias("leaves")))

    def section(ps: Column) -> Column:
        shown = F.array_join(F.transform(ps, lambda p: F.concat(short(p["h"]), p["leaves"])), ".")
        return F.struct(digest(F.transform(ps, lambda p: p["h"])).alias("h"), shown.alias("paragraphs"))

    def sections(ps: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(ps) - 1) / SECTION).cast("int"))
        return F.transform(starts, lambda s: section(F.slice(ps, s * SECTION + 1, SECTION)))

    return let(
        let(F.transform(F.split(text, "\n"), paragraph), sections),
        lambda ss: F.concat(digest(F.transform(ss, lambda s: s["h"])), F.lit(":"), F.array_join(F.transform(ss, lambda s: F.concat(short(s["h"]), F.lit("="), s["paragraphs"])), "/")),
    )


def root(print_: Column) -> Column:
    """The root of a fingerprint; equal exactly where the texts are."""
    return F.substring(print_, 1, 64)


def _sections(print_: Column) -> Column:
    return F.split(F.substring(print_, 66, 1 << 30), "/")


def _paragraphs(section: Column) -> Column:
    return F.split(F.substring(section, 10, 1 << 30), r"\.")


def likeness(a: Column, b: Column) -> Column:
    """Likeness of two fingerprints, 0 to 1: Dice's coefficient of their leaves.

    Of branches that repeat within a text one counts. All leaves below equal
    sections are shared; of the other sections, those below equal paragraphs;
    of what is left, equal leaves. Different texts without leaves: 0.
    """
    digits = lambda xs, beside: F.aggregate(xs, F.lit(0), lambda n, x: n + F.length(x) - beside(x))
    dots = lambda x: F.size(F.split(x, r"\."))
    leaves = lambda ps: F.array_distinct(F.flatten(F.transform(ps, lambda p: F.regexp_extract_all(F.substring(p, 9, 1 << 30), F.lit("[0-9a-f]{8}"), F.lit(0)))))
    below = lambda ss: F.array_distinct(F.flatten(F.transform(ss, _paragraphs)))

    def by_leaf(x: Column, y: Column, shared: Column) -> Column:
        both = 2.0 * (shared + F.size(F.array_intersect(x, y)))
        return F.coalesce(F.try_divide(both, 2 * shared + F.size(x) + F.size(y)), F.lit(0.0))

    def by_paragraph(x: Column, y: Column, shared: Column) -> Column:
        return let(F.array_intersect(x, y), lambda same: let(
            F.struct(leaves(F.array_except(x, same)).alias("x"), leaves(F.array_except(y, same)).alias("y"), (shared + digits(same, lambda _: F.lit(8)) / 8).alias("n")),
            lambda z: by_leaf(z["x"], z["y"], z["n"]),
        ))

    def by_section(x: Column, y: Column) -> Column:
        # A section's digits: its digest and mark, a digest for each paragraph, a dot between them; the rest is leaves.
        return let(F.array_intersect(x, y), lambda same: let(
            F.struct(below(F.array_except(x, same)).alias("x"), below(F.array_except(y, same)).alias("y"), (digits(same, lambda s: 8 + 9 * dots(s)) / 8).alias("n")),
            lambda z: by_paragraph(z["x"], z["y"], z["n"]),
        ))

    walked = let(F.struct(F.array_distinct(_sections(a)).alias("x"), F.array_distinct(_sections(b)).alias("y")), lambda z: by_section(z["x"], z["y"]))
    return F.when(root(a) == root(b), F.lit(1.0)).otherwise(walked)


def differing(a: Column, b: Column) -> Column:
    """0-based paragraphs of fingerprint b that differ from those of a at the same place; sections that are equal there aren't opened."""
    pa_ = _sections(a)

    def inside(section, s):
        there = F.coalesce(F.get(pa_, s), F.lit(""))
        pairs = F.arrays_zip(_paragraphs(section).alias("x"), F.when(there == "", F.array().cast("array<string>")).otherwise(_paragraphs(there)).alias("y"))
        found = F.filter(F.transform(pairs, lambda z, i: F.when(z["x"].isNull() | z["x"].eqNullSafe(z["y"]), F.lit(None)).otherwise(s * SECTION + i)), lambda i: i.isNotNull())
        return F.when(section == there, F.array().cast("array<int>")).otherwise(found)

    return F.when(root(a) == root(b), F.array().cast("array<int>")).otherwise(F.flatten(F.transform(_sections(b), inside)))


def _bucket(bounds: list[int], key: str) -> Column:
    """The number of bounds up to the key, found in two steps of about the root of their number each."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    # Each list is one literal of the plan: Spark folds the constant text.
    longs = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
    lists = F.transform(F.split(F.lit(";".join(",".join(map(str, p)) for p in parts)), ";"), lambda x: F.split(x, ",").cast("array<bigint>"))
    upto = lambda xs: F.size(F.filter(xs, lambda b: b <= F.col(key)))
    full = F.greatest(upto(longs([p[0] for p in parts])) - 1, F.lit(0))
    return (full * step + upto(F.get(lists, full))).cast("int")


def with_next(rows: DataFrame, payload: list[str], into: str = "_next", derived: dict[str, Column] | None = None) -> DataFrame:
    """rows (doc_id, text, ...) with ``into``, a struct of the payload columns of the next row by (doc_id, text); the last row's next is the first.

    Rows are dealt by ranges of doc_id between approximate quantiles; each range
    also gets a copy of the first rows of the range behind it, found by an id for
    each range. ``derived`` columns are made after that, once for each row, and
    may be in the payload.
    """
    key, bucket, guest, first, host = spare(rows, "key", "bucket", "guest", "first", "host")
    keyed = rows.withColumn(key, F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)))
    n = min(4 * partitions(rows), RANGES)
    ids = keyed.select(key)
    bounds = ids.agg(F.percentile_approx(key, [i / n for i in range(1, n)], max(10_000, 4 * n)).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    keyed = keyed.withColumn(bucket, _bucket(bounds, key)).withColumn(guest, F.lit(0))
    # A row for each range: the driver sees ids of ranges only.
    firsts = sorted((r[bucket], r["k"]) for r in ids.withColumn(bucket, _bucket(bounds, key)).groupBy(bucket).agg(F.min(key).alias("k")).collect())
    at = rows.sparkSession.createDataFrame([(firsts[i][1], firsts[i - 1][0]) for i in range(len(firsts))], f"{first} long, {host} int")
    guests = keyed.join(F.broadcast(at), F.col(key) == F.col(first)).withColumn(bucket, F.col(host)).withColumn(guest, F.lit(1)).drop(first, host)
    order = Window.partitionBy(bucket).orderBy(guest, key, "text")
    # With only one range all its rows are guests of their own range too; the last row's next is then the first of these.
    dealt = keyed.unionByName(guests).repartition(max(n // 4, 1), bucket).withColumns(derived or {})
    return dealt.withColumn(into, F.lead(F.struct(*payload)).over(order)).where(F.col(guest) == 0).drop(key, bucket, guest)


def edited(text: Column, next_text: Column) -> Column:
    """The last half (rounded down) of the code points replaced by the first as many of the next text."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), (n - half).cast("int")), F.substring(next_text, F.lit(1), half))


def op7_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", text_or_empty().alias("text"))
    rows = with_next(docs, ["text", "fingerprint"], derived={"fingerprint": fingerprint(F.col("text"))})
    made = edited(F.col("text"), F.col("_next.text"))
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), "fingerprint", F.col("_next.fingerprint").alias("_next"), made.alias("_edited"))
    rows = rows.select("doc_id", "n_chars", F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint", fingerprint(F.col("_edited")).alias("edited_fingerprint"), "_next")
    near = lambda other: likeness(F.col("fingerprint"), F.col(other))
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", near("edited_fingerprint").alias("near_edited"), near("_next").alias("near_next"))
