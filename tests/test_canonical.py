"""Canonical files: what tasks write and the commit lists, and files that break a rule."""

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventide.operators import validate as va
from eventide.schema import VERSION, VERSION_KEY
from eventide.sources import canonical as ca
from eventide.sources.files import lake_rows


def rows_of(spark, n, at="1700000000 + id % 50"):
    made = spark.range(n).selectExpr("sha2(cast(id AS string), 256) AS id", "repeat('ab', 32) AS pubkey", f"{at} AS created_at", "cast(id % 65536 AS int) AS kind", "array(array('t', cast(id AS string)), array('d', '')) AS tags", "concat('text ', id) AS content", "repeat('cd', 64) AS sig")
    return lake_rows(made)


def test_round_trip(spark, tmp_path):
    path = "file://" + str(tmp_path / "lake")
    own = rows_of(spark, 9000)
    twice = own.unionByName(own.limit(50).withColumn("sig", F.unhex(F.lit("ab" * 64))))
    made = ca.write_canonical(twice, path, files=3, most_bytes=400_000)
    assert made["rows"] == 9000 and made[VERSION_KEY] == VERSION and len(made["files"]) > 3 and sum(f["rows"] for f in made["files"]) == 9000
    assert (made["min_created_at"], made["max_created_at"]) == ("1700000000", "1700000049")
    ends = [(int(f["min_created_at"]), int(f["max_created_at"])) for f in made["files"]]
    assert ends == sorted(ends)
    back = ca.read_canonical(spark, path)
    assert back.count() == 9000 and back.where(F.hex("sig").startswith("AB")).count() == 50 and back.exceptAll(twice).count() == 0
    assert ca.verify(spark, path).collect() == [] and va.file_order_faults(back).count() == 0
    for f in made["files"]:
        meta = pq.read_metadata(tmp_path / "lake" / f["name"])
        assert meta.metadata == {VERSION_KEY.encode(): VERSION.encode()} and os.path.getsize(tmp_path / "lake" / f["name"]) == f["byte_size"]
        assert "isSigned=false" in str(pq.ParquetFile(tmp_path / "lake" / f["name"]).schema)
    assert not list((tmp_path / "lake/_staging").glob("*"))
    with pytest.raises(FileExistsError):
        ca.write_canonical(own, path)
    with pytest.raises(ValueError, match="nothing"):
        ca.write_canonical(own.limit(0), path + "-none")
    # The whole range of unsigned seconds.
    far = ca.write_canonical(rows_of(spark, 3, "id").withColumn("created_at", (F.col("created_at") * 9223372036854775807).cast("decimal(20,0)")), path + "-far", files=1)
    assert far["max_created_at"] == str(2 * (2**63 - 1)) and ca.verify(spark, path + "-far").collect() == []


def test_lost_tasks_leave_nothing(spark, tmp_path):
    path = "file://" + str(tmp_path / "lake")
    bad = rows_of(spark, 500).withColumn("created_at", F.when(F.col("kind") == 499, F.lit(-1)).otherwise(F.col("created_at")).cast("decimal(20,0)"))
    with pytest.raises(Exception):
        ca.write_canonical(bad, path, files=4)
    left = [f for _, _, files in os.walk(tmp_path / "lake") for f in files]
    assert left == []
    assert ca.write_canonical(rows_of(spark, 500), path, files=4)["rows"] == 500


def test_changed_and_missing_files(spark, tmp_path):
    path = "file://" + str(tmp_path / "lake")
    files = [tmp_path / "lake" / f["name"] for f in ca.write_canonical(rows_of(spark, 400), path, files=3)["files"]]
    data = bytearray(files[0].read_bytes())
    data[100] ^= 1
    files[0].write_bytes(data)
    files[1].write_bytes(files[1].read_bytes() + b"x")
    files[2].unlink()
    got = {(r.name[:11], r.fault) for r in ca.verify(spark, path).collect()}
    assert ("data/000000", "sha256") in got and {("data/000001", "byte_size"), ("data/000001", "sha256")} <= got and ("data/000002", "missing") in got


ROW = {"id": bytes(32), "pubkey": bytes(32), "created_at": 5, "kind": 1, "tags": [["t"]], "content": "", "sig": bytes(64)}


def broken(rows, schema=ca.STORED, meta=True, twice=False, **options):
    out = pa.BufferOutputStream()
    with pq.ParquetWriter(out, schema, **{"compression": "zstd", "store_schema": False} | options) as w:
        w.write_table(pa.Table.from_pylist(rows, schema))
        if meta:
            w.add_key_value_metadata({VERSION_KEY: VERSION if not twice else "2"})
    return ca.file_faults(out.getvalue())


def test_files_that_break_a_rule():
    two = [ROW, ROW | {"created_at": 6}]
    assert broken(two) == []
    assert broken(two, meta=False) == ["version"] and broken(two, twice=True) == ["version"]
    assert broken(two[::-1]) == ["order"] and broken([ROW, ROW]) == ["order"]
    assert broken([ROW | {"tags": [[]]}]) == ["empty_tag"]
    assert broken(two, write_statistics=False) == ["statistics"] and broken(two, compression="snappy") == ["compression"]
    assert broken(two, ca.STORED.set(2, pa.field("created_at", pa.int64(), False))) == ["schema"]
    assert broken(two, ca.STORED.set(5, pa.field("content", pa.string(), True))) == ["schema"]
    with pytest.raises(ValueError, match="null"):
        ca.stored(pa.RecordBatch.from_pylist([ROW | {"content": None}], pa.schema([pa.field(f.name, f.type) for f in ca.STORED])))


def test_sizes_and_cuts(spark):
    from eventide.operators.publish import cuts, row_bytes

    own = rows_of(spark, 50).coalesce(1).withColumn("n", row_bytes())
    table = pa.Table.from_batches([pa.record_batch([ca.stored(b)[f.name].combine_chunks() for f in ca.STORED], schema=ca.STORED) for b in own.drop("n").toArrow().to_batches()])
    size = ca.sizes(table.slice(3, 40))
    assert size.tolist() == [r.n for r in own.collect()][3:43]
    rng = np.random.default_rng(3)
    for _ in range(200):
        n, most = rng.integers(1, 30, 40), int(rng.integers(5, 60))
        # In batches, as a task gets them.
        parts, part, held = [], 0, 0
        for batch in np.split(n, sorted(rng.integers(0, 40, 3))):
            for i, (a, b, more) in enumerate(ca.runs(batch, most, held)):
                part, held = (part + 1, 0) if i else (part, held)
                parts += [part] * (b - a)
                held += more
        assert parts == list(cuts(n.tolist(), most))


def test_manifest_is_json(spark, tmp_path):
    path = "file://" + str(tmp_path / "lake")
    made = ca.write_canonical(rows_of(spark, 10), path, files=1)
    assert json.loads((tmp_path / "lake" / ca.MANIFEST).read_bytes()) == made
