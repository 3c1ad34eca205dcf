"""A build that is kept and advanced: products of a snapshot, published as a run, and deltas applied to them.

The events that were counted are kept as parts, one for each run, so a delta
writes only its own; the rollups are small and written anew, added up. The
overview is made again from all parts, as its windows move with ``as_of``. A
run becomes visible as a whole, by the pointer (:mod:`publish`); its evidence
names the snapshot, ``as_of``, the version and the folders of the parts. A delta
is published behind the run that it was applied to or not at all, so of two
that are applied to the same run one is refused, and nothing is lost.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.operators import rollups as ro
from eventide.operators.lifecycle import Products, advanced, build, check, reject_conflicts
from eventide.operators.publish import Store, current, pointer, publish, run_folder, run_id

#: Changes with what is counted.
QUERY_VERSION = "1"
ROLLUPS = ("daily", "daily_kind", "kinds")
_CANONICAL = "canonical"


@dataclass
class Summary:
    """What a delta brought."""

    delta_physical_rows: int
    delta_logical_events: int
    delta_internal_duplicates: int
    existing_events: int
    inserted_events: int
    already_applied: bool = False


def state(spark: SparkSession, base: str) -> dict | None:
    """The evidence of the current run, and its folder."""
    now = pointer(spark, base)
    return None if now is None else json.loads(Store(spark, base).read(f"{now['folder']}/evidence.json")) | {"folder": now["folder"]}


def _read(spark: SparkSession, base: str, now: dict) -> Products:
    at = base.rstrip("/")
    own = [spark.read.parquet(f"{at}/{now['folder']}/{name}") for name in ROLLUPS]
    return Products(spark.read.parquet(*[f"{at}/{part}/{_CANONICAL}" for part in now["parts"]]), *own, now["physical"])


def read(spark: SparkSession, base: str) -> Products:
    """The products of the current run."""
    now = state(spark, base)
    if now is None:
        raise FileNotFoundError("no build is published")
    return _read(spark, base, now)


def overview(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{state(spark, base)['folder']}/overview")


def _publish(spark: SparkSession, base: str, snapshot: str, as_of: int, made: Products, part: DataFrame, before: dict | None, lease) -> None:
    run = run_id(snapshot, QUERY_VERSION, as_of)
    folder, parts, expected = run_folder(run), before["parts"] if before else [], before["run_id"] if before else None
    products = {_CANONICAL: part, **{n: getattr(made, n) for n in ROLLUPS}, "overview": ro.overview(made.canonical, as_of)}
    evidence = {"snapshot_id": snapshot, "as_of": as_of, "query_version": QUERY_VERSION, "physical": made.physical, "parts": [*parts, folder], "accounting": check(made)}
    publish(spark, base, run, products, evidence, expected, folder, lease)


def start(spark: SparkSession, base: str, snapshot: str, events: DataFrame, as_of: int, lease=None) -> None:
    """Build the products of a snapshot as the first run."""
    if current(spark, base) is not None:
        raise FileExistsError("a build is published; advance it by deltas")
    made = build(events)
    _publish(spark, base, snapshot, as_of, made, made.canonical, None, lease)


def advance(spark: SparkSession, base: str, target: str, previous: str, added: DataFrame, as_of: int, dry_run: bool = False, lease=None) -> Summary:
    """Apply the objects that target has beside previous; what is applied already changes nothing.

    ``dry_run`` does all counting and checking and leaves the build as it is.
    The added objects are read once: what they bring is written down and used
    from there.
    """
    now = state(spark, base)
    if now is None:
        raise FileNotFoundError("no build is published")
    if now["snapshot_id"] == target:
        if (now["as_of"], now["query_version"]) != (as_of, QUERY_VERSION):
            raise ValueError(f"the target was built with as_of {now['as_of']} and version {now['query_version']}, asked for {as_of} and {QUERY_VERSION}")
        check(_read(spark, base, now))
        return Summary(added.count(), 0, 0, 0, 0, already_applied=True)
    if now["snapshot_id"] != previous:
        raise ValueError(f"the build is at {now['snapshot_id']}, the delta begins at {previous}")
    store, work = Store(spark, base), f"work/{uuid.uuid4().hex}"
    try:
        before = _read(spark, base, now)
        # One pass over the objects, one over the ids that are kept.
        added.groupBy("id", "created_at", "kind").agg(F.count("*").alias("copies")).write.parquet(f"{store.base}/{work}/delta")
        delta = spark.read.parquet(f"{store.base}/{work}/delta")
        reject_conflicts(delta)
        known = before.canonical.select("id", F.struct("created_at", "kind").alias("kept"))
        delta.join(known, "id", "left").write.parquet(f"{store.base}/{work}/met")
        met = spark.read.parquet(f"{store.base}/{work}/met")
        wrong = met.where("kept IS NOT NULL AND NOT (struct(created_at, kind) <=> kept)").orderBy("id").limit(5).collect()
        if wrong:
            raise ValueError(f"conflicting events: {[r['id'] for r in wrong]}")
        fresh = met.where("kept IS NULL").select("id", "created_at", "kind")
        n = met.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("physical"), F.count("*").alias("logical"), F.count_if(F.col("kept").isNull()).alias("inserted")).first()
        summary = Summary(n.physical, n.logical, n.physical - n.logical, n.logical - n.inserted, n.inserted)
        if not dry_run:
            made = advanced(before, fresh, n.physical)
            _publish(spark, base, target, as_of, made, fresh, now, lease)
        return summary
    finally:
        store.delete(work)


def described(summary: Summary) -> dict[str, int | bool]:
    return asdict(summary)
