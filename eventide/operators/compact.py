"""A lake of sorted runs that is kept small by merging: what is added is a run of level 0, and levels that hold too many are merged upwards.

The runs of the lake are named by the pointer's evidence (:mod:`publish`). An
addition or a compaction writes new runs beside the others and turns the
pointer, as one step, behind the state it began at; readers that have the state
before keep their files. Runs that no state needs are swept later.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from eventide.operators.catalog import compaction, digest
from eventide.operators.publish import Store, history, pointer, publish, run_folder, sweep
from eventide.operators.validate import one_per_id
from eventide.schema import EVENT

#: Runs that are merged into one, and runs that a level may hold.
FAN_IN, MOST = 8, 8


def state(spark: SparkSession, base: str, turn: dict | None = None) -> dict[str, dict]:
    """The lake's runs: level, folder and rows by name."""
    now = turn or pointer(spark, base)
    return {} if now is None else json.loads(Store(spark, base).read(f"{now['folder']}/evidence.json"))["lake"]


def read(spark: SparkSession, base: str, turn: dict | None = None) -> DataFrame:
    """The lake's events, each id once, of the current state or of that of a turn."""
    runs = state(spark, base, turn)
    at = base.rstrip("/")
    paths = [f"{at}/{r['folder']}/events" for r in runs.values()]
    rows = spark.read.schema(EVENT).parquet(*paths) if paths else spark.createDataFrame([], EVENT)
    return one_per_id(rows)


def _sorted_run(spark: SparkSession, base: str, rows: DataFrame, folder: str, files: int | None) -> int:
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = f"{base.rstrip('/')}/{folder}/events"
    one_per_id(rows).repartitionByRange(n, "created_at", "id").sortWithinPartitions("created_at", "id").write.option("compression", "zstd").parquet(out)
    return spark.read.parquet(out).count()


def _turn(spark: SparkSession, base: str, now: dict | None, runs: dict[str, dict], lease) -> None:
    name = digest([now["version"] if now else 0, runs])[:32]
    publish(spark, base, name, {}, {"lake": runs}, now["run_id"] if now else None, lease=lease)


def add(spark: SparkSession, base: str, rows: DataFrame, files: int | None = None, lease=None) -> str:
    """The rows as a run of level 0; its name. Stale if the lake was changed meanwhile."""
    now = pointer(spark, base)
    runs = state(spark, base, now) if now else {}
    folder = run_folder("added")
    name = f"run-{(now['version'] if now else 0) + 1:012d}"
    n = _sorted_run(spark, base, rows, folder, files)
    _turn(spark, base, now, runs | {name: {"level": 0, "folder": folder, "rows": n}}, lease)
    return name


def compact(spark: SparkSession, base: str, fan_in: int = FAN_IN, most_per_level: int = MOST, files: int | None = None, lease=None) -> list[dict]:
    """Carry out the plan of merges and turn the pointer once; the steps, none where no level is too full.

    A merge reads ``fan_in`` runs at most. A run that is only a step on the way
    to another one is written, read and left to be swept.
    """
    now = pointer(spark, base)
    runs = state(spark, base, now) if now else {}
    steps = compaction({name: r["level"] for name, r in runs.items()}, fan_in, most_per_level)
    if not steps:
        return []
    at, made = base.rstrip("/"), dict(runs)
    for step in steps:
        inputs = [made.pop(name) for name in step["inputs"]]
        folder = run_folder("merged")
        rows = spark.read.schema(EVENT).parquet(*[f"{at}/{r['folder']}/events" for r in inputs])
        made[step["output"]] = {"level": step["level"], "folder": folder, "rows": _sorted_run(spark, base, rows, folder, files)}
    _turn(spark, base, now, made, lease)
    return steps


def clear(spark: SparkSession, base: str, older_than: float, states: int = 1) -> list[str]:
    """Delete folders of runs that the newest ``states`` states don't need and that are older than so many seconds."""
    kept = {r["folder"] for turn in history(spark, base)[-states:] for r in state(spark, base, turn).values()}
    return sweep(spark, base, older_than, kept)


def level_counts(runs: dict[str, dict]) -> dict[int, int]:
    out: dict[int, int] = {}
    for r in runs.values():
        out[r["level"]] = out.get(r["level"], 0) + 1
    return out
