"""Snapshot catalogs, delta plans, batches, compaction, work-unit states."""

from __future__ import annotations

import hashlib
import json
import shutil
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def canonical_json(value) -> bytes:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()


def digest(value) -> str:
    return hashlib.sha256(canonical_json(value)).hexdigest()


@dataclass(frozen=True, order=True)
class CatalogObject:
    object_key: str
    work_unit_id: str
    part_number: int
    byte_size: int
    sha256: str
    writer_version: str
    row_count: int
    min_created_at: str | None = None
    max_created_at: str | None = None


@dataclass(frozen=True)
class Snapshot:
    """Objects in order of their keys; the id is a hash of them all."""

    objects: tuple[CatalogObject, ...]
    aliases: tuple[tuple[str, str], ...] = ()

    def __post_init__(self):
        keys = [o.object_key for o in self.objects]
        if keys != sorted(set(keys)):
            raise ValueError("objects must be in order of distinct keys")

    @property
    def snapshot_id(self) -> str:
        return digest([asdict(o) for o in self.objects])

    def locations(self, base: str) -> list[str]:
        return [f"{base.rstrip('/')}/{o.object_key}" for o in self.objects]

    def frame(self, spark) -> DataFrame:
        schema = "object_key string, work_unit_id string, part_number int, byte_size long, sha256 string, writer_version string, row_count long, min_created_at string, max_created_at string"
        return spark.createDataFrame([tuple(asdict(o).values()) for o in self.objects], schema)


def snapshot(objects: Iterable[CatalogObject], aliases: Iterable[tuple[str, str]] = ()) -> Snapshot:
    return Snapshot(tuple(sorted(set(objects))), tuple(sorted(set(aliases))))


def union(fragments: Iterable[Snapshot]) -> Snapshot:
    """One catalog of fragments; equal objects count once, a key with two identities is refused, so is an alias of two targets."""
    objects: dict[str, CatalogObject] = {}
    aliases: dict[str, str] = {}
    for part in fragments:
        for o in part.objects:
            if objects.setdefault(o.object_key, o) != o:
                raise ValueError(f"conflicting object {o.object_key}")
        for name, target in part.aliases:
            if aliases.setdefault(name, target) != target:
                raise ValueError(f"conflicting alias {name}")
    return snapshot(objects.values(), aliases.items())


def require_extension(old: Snapshot, new: Snapshot) -> tuple[CatalogObject, ...]:
    """The objects added; ValueError if new lacks or changes one of old."""
    lost = set(old.objects) - set(new.objects)
    if lost:
        raise ValueError(f"not an extension: {sorted(o.object_key for o in lost)[:5]}")
    return tuple(sorted(set(new.objects) - set(old.objects)))


@dataclass(frozen=True)
class Baseline:
    run_id: str
    query_version: str
    objects: tuple[CatalogObject, ...]


@dataclass(frozen=True)
class DeltaPlan:
    kind: str  # full, no_change, incremental or affected_period
    added: tuple[CatalogObject, ...]
    removed: tuple[CatalogObject, ...]
    unchanged: int
    previous_run: str | None = None
    affected: tuple[int, int] | None = None
    affected_complete: bool = True
    added_bytes: int = field(default=0)
    added_rows: int = field(default=0)


def plan_delta(new: Snapshot, base: Baseline | None, query_version: str) -> DeltaPlan:
    """How to get from what a run applied to a snapshot; an applied key whose content changed is refused."""
    sums = lambda xs: {"added_bytes": sum(o.byte_size for o in xs), "added_rows": sum(o.row_count for o in xs)}
    if base is None or base.query_version != query_version:
        return DeltaPlan("full", new.objects, (), 0, affected=_range(new.objects), affected_complete=_complete(new.objects), **sums(new.objects))
    identity = lambda o: (o.work_unit_id, o.sha256, o.byte_size, o.row_count)
    have = {o.object_key: o for o in base.objects}
    changed = [o.object_key for o in new.objects if o.object_key in have and identity(have[o.object_key]) != identity(o)]
    if changed:
        raise ValueError(f"immutable objects changed: {changed[:5]}")
    keys = {o.object_key for o in new.objects}
    added, removed = tuple(o for o in new.objects if o.object_key not in have), tuple(sorted(o for o in base.objects if o.object_key not in keys))
    kind = "affected_period" if removed else "incremental" if added else "no_change"
    return DeltaPlan(kind, added, removed, len(new.objects) - len(added), base.run_id, _range(added + removed), _complete(added + removed), **sums(added))


def _complete(objects) -> bool:
    return all(o.min_created_at is not None and o.max_created_at is not None for o in objects)


def _range(objects) -> tuple[int, int] | None:
    low, high = [int(o.min_created_at) for o in objects if o.min_created_at is not None], [int(o.max_created_at) for o in objects if o.max_created_at is not None]
    return (min(low), max(high)) if low and high else None


def delta_frames(ledger: DataFrame, catalog: DataFrame) -> DataFrame:
    """The same comparison for ledgers too long for the driver: object_key and change (added, removed, changed, unchanged)."""
    parts = ["work_unit_id", "sha256", "byte_size", "row_count"]
    side = lambda df, s: df.select("object_key", F.struct(*parts).alias(s))
    both = side(ledger, "l").join(side(catalog, "c"), "object_key", "full_outer")
    change = F.when(F.col("l").isNull(), "added").when(F.col("c").isNull(), "removed").when(F.col("l") != F.col("c"), "changed").otherwise("unchanged")
    return both.select("object_key", change.alias("change"))


def batches(objects: Iterable[CatalogObject], most_bytes: int, most_rows: int) -> list[list[CatalogObject]]:
    """Objects in order, cut where a batch would go over a limit; an object over a limit by itself is refused."""
    out: list[list[CatalogObject]] = []
    size = rows = 0
    for o in objects:
        if o.byte_size > most_bytes or o.row_count > most_rows:
            raise ValueError(f"object {o.object_key} is over the limits of a batch")
        if not out or size + o.byte_size > most_bytes or rows + o.row_count > most_rows:
            out.append([])
            size = rows = 0
        out[-1].append(o)
        size, rows = size + o.byte_size, rows + o.row_count
    return out


def compaction(runs: dict[str, int], fan_in: int, most_per_level: int) -> list[dict]:
    """Merges (level, inputs, output) of runs (name to level) until no level holds too many; names are taken in order."""
    if fan_in < 2 or most_per_level < 1:
        raise ValueError("fan_in must be 2 or more and most_per_level 1 or more")
    levels: dict[int, list[str]] = {}
    for name, level in sorted(runs.items()):
        levels.setdefault(level, []).append(name)
    steps: list[dict] = []
    while full := [k for k in sorted(levels) if len(levels[k]) > most_per_level]:
        at = full[0]
        inputs, levels[at] = levels[at][:fan_in], levels[at][fan_in:]
        made = "run-" + digest([at + 1, inputs])[:16]
        levels[at + 1] = sorted([*levels.get(at + 1, []), made])
        steps.append({"level": at + 1, "inputs": inputs, "output": made})
    return steps


def disk_preflight(path: str, needed: int, reserve: int = 0) -> int:
    """Free bytes beyond what is needed; OSError if there are too few."""
    left = shutil.disk_usage(path).free - needed - reserve
    if left < 0:
        raise OSError(f"{-left} bytes too few at {path}")
    return left


#: Which state a work unit may go to from which.
STATES = {
    "pending": {"writing"}, "writing": {"validated", "failed"}, "validated": {"uploading", "failed"}, "uploading": {"uploaded", "failed"},
    "uploaded": {"published", "failed"}, "published": {"source_committed"}, "failed": {"writing"}, "source_committed": set(),
}


def moved(state: str, to: str) -> str:
    """The new state; staying is allowed, anything not in STATES isn't."""
    if to != state and to not in STATES[state]:
        raise ValueError(f"{state} can't become {to}")
    return to


def completion_audit(manifest: DataFrame, inventory: DataFrame) -> DataFrame:
    """Sources of a manifest (source_key, sha256, byte_size) against work units (source_key, sha256, state): complete, incomplete, failed, changed, missing or unlisted."""
    m, i = manifest.select("source_key", F.col("sha256").alias("m")), inventory.select("source_key", F.col("sha256").alias("i"), "state")
    both = m.join(i, "source_key", "full_outer")
    kind = (
        F.when(F.col("m").isNull(), "unlisted").when(F.col("i").isNull(), "missing").when(F.col("m") != F.col("i"), "changed")
        .when(F.col("state") == "source_committed", "complete").when(F.col("state") == "failed", "failed").otherwise("incomplete")
    )
    return both.select("source_key", "state", kind.alias("class"))
