"""Sources, validation, sinks, work units, streaming."""

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from eventide.operators import catalog as ca
from eventide.operators import lifecycle as li
from eventide.operators import publish as pu
from eventide.operators import validate as va
from eventide.sources import files as fi
from eventide.streaming import ingest

SECRET = 0xB7E151628AED2A6ABF7158809CF4F3C762E7160F38B4DA56A784D9045190CFEF


def event(content="x", at=1000, kind=1, tags=(), sign=False):
    tags = [list(t) for t in tags]
    pub = va.sign_schnorr(bytes(32), SECRET)[0].hex() if sign else "ab" * 32
    text = json.dumps([0, pub, at, kind, tags, content], separators=(",", ":"), ensure_ascii=False)
    i = hashlib.sha256(text.encode()).hexdigest()
    sig = va.sign_schnorr(bytes.fromhex(i), SECRET)[1].hex() if sign else "cd" * 64
    return {"id": i, "pubkey": pub, "created_at": at, "kind": kind, "tags": tags, "content": content, "sig": sig}


HARD = 'quote " back \\ line \n tab \t nul-ish \x01 del \x7f bell \x08 feed \x0c 🦀 / é  '


def write(path, *lines):
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def test_ids_are_computed_as_json_has_them(spark, tmp_path):
    write(tmp_path / "a.jsonl", event(HARD, tags=[["t", HARD], ["alt", ""]]), event("", kind=0))
    assert {r.status for r in fi.jsonl(spark, str(tmp_path)).rows.collect()} == {"ok"}


def test_jsonl_classes(spark, tmp_path):
    good, bad = event("a"), event("b") | {"content": "tampered"}
    repaired = event("r", tags=[["e", "eventid", "0", "true", ""]])
    write(tmp_path / "a.jsonl", good, "", "  ", bad, "{nonsense", "{}", repaired | {"tags": [["e", "eventid", 0, True, None]]}, event("k") | {"kind": 70000}, event("t", tags=[[]]), event("h") | {"id": "zz"})
    write(tmp_path / "b.json", event("second"))
    (tmp_path / "c.txt").write_text("not read")
    s = fi.jsonl(spark, str(tmp_path))
    counts = {r.status: r.n for r in s.metrics().collect()}
    assert counts == {"ok": 3, "bad_id": 1, "invalid_json": 1, "missing_field": 1, "bad_kind": 1, "empty_tag": 1, "bad_hex": 1}
    assert s.events.count() == 3 and s.rejects.count() == 6 and fi.jsonl(spark, str(tmp_path), limit=1).events.count() == 2
    with pytest.raises(ValueError, match="rejected"):
        s.strict()
    with pytest.raises(FileNotFoundError):
        fi.jsonl(spark, str(tmp_path / ".."))


def test_signatures(spark, tmp_path):
    # First vector of the public specification.
    key, sig = va.sign_schnorr(bytes(32), 3)
    assert key.hex() == "f9308a019258c31049344f85f89d5229b531c845836f99b08601f113bce036f9" and sig.hex().startswith("e907831f80848d1069a5371b40241036") and va.verify_schnorr(bytes(32), key, sig)
    assert not va.verify_schnorr(b"\1" + bytes(31), key, sig) and not va.verify_schnorr(bytes(32), key, sig[:-1] + b"\0") and not va.verify_schnorr(bytes(32), b"\xff" * 32, sig)
    write(tmp_path / "a.jsonl", event("s", sign=True), event("u"))
    assert {r.content: r.status for r in fi.jsonl(spark, str(tmp_path), signatures=True).rows.collect()} == {"s": "ok", "u": "bad_signature"}


def test_protobuf_and_segments(spark, tmp_path):
    evs = [event("a", tags=[["t", "x"], ["e", ""]]), event(HARD), event("c", at=0)]
    messages = [fi.encode_event(e) for e in evs]
    assert [fi.decode_event(m) for m in messages] == evs
    size = lambda n: bytes([n & 127 | 128, n >> 7]) if n > 127 else bytes([n])
    pb, seg = tmp_path / "pb", tmp_path / "seg"
    pb.mkdir(), seg.mkdir()
    stream = b"".join(size(len(m)) + m for m in messages)
    (pb / "a.pb").write_bytes(stream)
    (pb / "b.gz").write_bytes(gzip.compress(stream))
    assert fi.protobuf(spark, str(pb)).events.count() == 6
    notes = [fi.encode_note(e) for e in evs]
    assert [fi.decode_note(m) for m in notes] == evs
    framed = b"".join(len(m).to_bytes(4, "little") + m for m in notes)
    (seg / "a.seg").write_bytes(framed + (3).to_bytes(4, "little") + b"\xff\xff\xff")
    s = fi.segments(spark, str(seg))
    assert s.events.count() == 3 and [r.status for r in s.rejects.collect()] == ["invalid_message"]
    assert pu.quarantine(s, str(tmp_path / "q")) == 1
    (seg / "b.seg").write_bytes(framed[:-5])
    with pytest.raises(ValueError, match="cut off"):
        fi.segments(spark, str(seg))
    s = fi.segments(spark, str(seg), salvage=True)
    assert s.events.count() == 5 and {r.status for r in s.rejects.collect()} == {"invalid_message", "truncated"}
    (seg / "c.seg").write_bytes((1 << 30).to_bytes(4, "little"))
    assert fi.segments(spark, str(seg), salvage=True).rejects.where("status = 'oversize'").count() == 1
    # Gzipped, whole and cut off; and protobuf messages in frames.
    packed, other = tmp_path / "packed", tmp_path / "other"
    packed.mkdir(), other.mkdir()
    (packed / "a.notepack.gz").write_bytes(gzip.compress(framed))
    (packed / "b.gz").write_bytes(gzip.compress(framed)[:-20])
    s = fi.segments(spark, str(packed), salvage=True)
    assert s.events.count() >= 3 and s.rejects.where("status = 'truncated'").count() == 1
    (other / "a.seg").write_bytes(b"".join(len(m).to_bytes(4, "little") + m for m in messages))
    assert fi.segments(spark, str(other), message="protobuf").events.count() == 3 and fi.segments(spark, str(other)).rejects.count() == 3


def test_packed_notes():
    """The layout by a note written out by hand, and what is refused."""
    ids = bytes(range(32)), bytes(range(1, 33)), bytes(64)
    raw = b"\x01" + b"".join(ids) + b"\xac\x02" + b"\x07" + b"\x03\xc3\xa9!" + b"\x02" + b"\x02" + b"\x02e" + b"\x05\xab\xcd" + b"\x01" + b"\x00"
    want = {"id": ids[0].hex(), "pubkey": ids[1].hex(), "sig": ids[2].hex(), "created_at": 300, "kind": 7, "content": "é!", "tags": [["e", "abcd"], [""]]}
    assert fi.decode_note(raw) == want and fi.encode_note(want) == raw
    kind = len(b"\x01") + 128 + 2
    for bad in (raw[:-1], raw + b"\x00", b"\x02" + raw[1:], b"", raw[:kind] + b"\x80\x80\x04" + raw[kind + 1 :], raw.replace(b"\xc3\xa9", b"\xff\xa9"), raw[: kind + 5] + b"\x7f" + raw[kind + 6 :], b"\xff" * 12):
        with pytest.raises((ValueError, IndexError)):
            fi.decode_note(bad)


def test_lake_round_trip(spark, tmp_path):
    rows = [event(str(i), at=1000 - i % 7) for i in range(40)]
    other = rows[0] | {"sig": "00" * 64}
    write(tmp_path / "a.jsonl", *rows, rows[1], other)
    lake_rows = fi.lake_rows(fi.jsonl(spark, str(tmp_path)).events)
    facts = pu.write_lake(lake_rows, str(tmp_path / "lake"), files=3)
    assert facts["rows"] == 40 and facts["min_created_at"] == "994"
    back = fi.lake(spark, str(tmp_path / "lake/data"))
    assert back.where(F.hex("id") == rows[0]["id"].upper()).first().sig == bytes(64)
    f = va.canonical_faults(back).first()
    assert all(v == 0 for v in f.asDict().values()) and va.file_order_faults(back).count() == 0
    assert fi.lake_with_files(spark, str(tmp_path / "lake/data")).select("file").distinct().count() == 3
    with pytest.raises(FileExistsError):
        pu.write_lake(lake_rows, str(tmp_path / "lake"))
    with pytest.raises(ValueError, match="nothing"):
        pu.write_lake(lake_rows.limit(0), str(tmp_path / "none"))
    faults = va.canonical_faults(back.unionByName(back.limit(1)).withColumn("content", F.concat("content", F.lit("!")))).first()
    assert faults.repeats == 1 and faults.ids == 41
    size = back.select(pu.row_bytes().alias("n")).first().n
    for most, want in ((3 * size, 14), (size - 1, 40), (10**9, 1)):
        parts = pu.sized_parts(back, most, ranges=1).orderBy("created_at", "id").collect()
        assert len({r.part for r in parts}) == want and [r.part for r in parts] == sorted(r.part for r in parts)
    assert list(pu.cuts([5, 5, 1, 20, 3, 3, 4, 1], 10)) == [0, 0, 1, 2, 3, 3, 3, 4] and list(pu.cuts([], 10)) == []
    pu.write_lake(lake_rows, str(tmp_path / "sized"), files=1, most_bytes=3 * size)
    sized = fi.lake_with_files(spark, str(tmp_path / "sized/data"))
    assert sized.select("file").distinct().count() == 14 and sized.columns[:-1] == back.columns and va.file_order_faults(fi.lake(spark, str(tmp_path / "sized/data"))).count() == 0
    with pytest.raises(ValueError, match="most_bytes"):
        pu.sized_parts(back, 0)
    with pytest.raises(ValueError, match="schema"):
        fi.require(back.drop("sig"))


def test_unsigned_seconds(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from eventide.schema import warehouse

    t = pa.table({"id": pa.array([b"\1" * 32, b"\2" * 32], pa.binary(32)), "pubkey": pa.array([b"p" * 32] * 2, pa.binary(32)), "created_at": pa.array([5, 2**63], pa.uint64()), "kind": pa.array([1, 65535], pa.uint16()), "tags": pa.array([[], [["alt"], ["d", ""]]], pa.list_(pa.list_(pa.string()))), "content": ["", " \n\t"], "sig": pa.array([b"s" * 64] * 2, pa.binary(64))})
    pq.write_table(t, tmp_path / "x.parquet")
    back = fi.lake(spark, str(tmp_path / "x.parquet"))
    assert {int(r.created_at) for r in back.collect()} == {5, 2**63} and [r.created_at for r in warehouse(back).collect()] == [5]


def test_publish(spark, tmp_path):
    base, df = str(tmp_path / "runs"), spark.range(3)
    assert pu.current(spark, base) is None
    assert pu.publish(spark, base, "r1", {"p": df}, {"x": 1}, None) and not pu.publish(spark, base, "r1", {"p": df}, {}, None)
    with pytest.raises(ValueError, match="stale"):
        pu.publish(spark, base, "r2", {"p": df}, {}, None)
    assert pu.publish(spark, base, "r2", {"p": spark.range(5)}, {}, "r1") and pu.read_current(spark, base, "p").count() == 5 and pu.read_current(spark, base, "p").first().run_id == "r2"
    assert pu.run_id("s", "v", 1) == pu.run_id("s", "v", 1) != pu.run_id("s", "v", 2)
    store = pu.Store(spark, base)
    store.write("x.json", b"one")
    with pytest.raises(FileExistsError):
        store.write("x.json", b"other")


def test_work_unit_goes_on(spark, tmp_path, monkeypatch):
    src = tmp_path / "in"
    src.mkdir()
    write(src / "a.jsonl", event("a"), event("b"), "{bad")
    source, base = fi.jsonl(spark, str(src)), str(tmp_path / "lake")
    real = pu.write_lake
    monkeypatch.setattr(pu, "write_lake", lambda *a, **b: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        pu.work_unit(spark, base, "a", "f" * 64, source)
    assert json.loads(pu.Store(spark, base).read(f"units/{'f' * 64}.json"))["state"] == "failed"
    monkeypatch.setattr(pu, "write_lake", real)
    done = pu.work_unit(spark, base, "a", "f" * 64, source)
    assert (done["state"], done["rejected"], done["manifest"]["rows"]) == ("source_committed", 1, 2) and pu.work_unit(spark, base, "a", "f" * 64, source) == done


def test_work_units_by_size_and_sum(spark, tmp_path):
    """A unit's files keep to the size; a source that isn't the one it is said to be fails."""
    src, base = tmp_path / "in", str(tmp_path / "lake")
    src.mkdir()
    write(src / "a.jsonl", *[event(str(i), at=1000 + i) for i in range(30)])
    path, source = "file://" + str(src / "a.jsonl"), fi.jsonl(spark, str(src))
    true = hashlib.sha256((src / "a.jsonl").read_bytes()).hexdigest()
    assert pu.source_sha256(spark, path) == true
    with pytest.raises(pu.SourceChanged):
        pu.work_unit(spark, base, "a", "0" * 64, source, source_path=path)
    assert json.loads(pu.Store(spark, base).read(f"units/{'0' * 64}.json"))["state"] == "failed" and not pu.Store(spark, base).exists(f"objects/{'0' * 64}/data")
    done = pu.work_unit(spark, base, "a", true, source, most_bytes=1000, source_path=path)
    kept = fi.lake_with_files(spark, f"{base}/objects/{true}/data")
    assert done["state"] == "source_committed" and kept.count() == 30 and kept.select("file").distinct().count() > 5


def obj(key, sha="s", low="10", high="20", **more):
    return ca.CatalogObject(key, "u", 0, more.get("size", 10), sha, "w", more.get("rows", 5), low, high)


def test_catalogs_and_plans(spark):
    a, b, c = obj("a"), obj("b"), obj("c", low="5")
    s = ca.snapshot([b, a, a])
    assert [o.object_key for o in s.objects] == ["a", "b"] and s.locations("s3://x/") == ["s3://x/a", "s3://x/b"] and ca.union([s, ca.snapshot([c])]).objects == (a, b, c)
    with pytest.raises(ValueError, match="conflicting"):
        ca.union([s, ca.snapshot([obj("a", sha="t")])])
    with pytest.raises(ValueError, match="alias"):
        ca.union([ca.snapshot([a], [("x", "a")]), ca.snapshot([b], [("x", "b")])])
    assert ca.require_extension(s, ca.snapshot([a, b, c])) == (c,)
    with pytest.raises(ValueError, match="extension"):
        ca.require_extension(s, ca.snapshot([a, c]))
    base = ca.Baseline("r", "v1", (a, b))
    kinds = [ca.plan_delta(new, old, v).kind for new, old, v in ((s, None, "v1"), (s, base, "v2"), (s, base, "v1"), (ca.snapshot([a, b, c]), base, "v1"), (ca.snapshot([a, c]), base, "v1"))]
    assert kinds == ["full", "full", "no_change", "incremental", "affected_period"]
    p = ca.plan_delta(ca.snapshot([a, c]), base, "v1")
    assert (p.affected, p.unchanged, p.added, p.removed) == ((5, 20), 1, (c,), (b,))
    with pytest.raises(ValueError, match="immutable"):
        ca.plan_delta(ca.snapshot([obj("a", sha="t"), b]), base, "v1")
    got = {r.object_key: r.change for r in ca.delta_frames(s.frame(spark), ca.snapshot([a, obj("b", sha="t"), c]).frame(spark)).collect()}
    assert got == {"a": "unchanged", "b": "changed", "c": "added"}


def test_batches_compaction_states(tmp_path):
    assert [[o.object_key for o in x] for x in ca.batches([obj("a"), obj("b"), obj("c")], 20, 100)] == [["a", "b"], ["c"]]
    with pytest.raises(ValueError):
        ca.batches([obj("a", size=30)], 20, 100)
    steps = ca.compaction({f"r{i}": 0 for i in range(9)}, 3, 2)
    assert [s["level"] for s in steps] == [1, 1, 1, 2] or len(steps) >= 3
    assert steps == ca.compaction({f"r{i}": 0 for i in range(9)}, 3, 2)
    with pytest.raises(ValueError):
        ca.compaction({}, 1, 1)
    assert ca.moved("pending", "writing") == "writing" and ca.moved("failed", "failed") == "failed"
    with pytest.raises(ValueError):
        ca.moved("published", "failed")
    assert ca.disk_preflight(str(tmp_path), 1) > 0
    with pytest.raises(OSError):
        ca.disk_preflight(str(tmp_path), 1 << 60)


def test_audit(spark):
    m = spark.createDataFrame([("a", "1", 1), ("b", "1", 1), ("c", "1", 1), ("d", "1", 1)], "source_key string, sha256 string, byte_size long")
    i = spark.createDataFrame([("a", "1", "source_committed"), ("b", "2", "source_committed"), ("c", "1", "failed"), ("e", "1", "pending")], "source_key string, sha256 string, state string")
    assert {r.source_key: r["class"] for r in ca.completion_audit(m, i).collect()} == {"a": "complete", "b": "changed", "c": "failed", "d": "missing", "e": "unlisted"}


def test_ledger_and_digest(spark):
    o = lambda *k: spark.createDataFrame([(x,) for x in k], "object_key string")
    first = pu.ledger(None, o("a", "b"), "r1")
    rows = {r.object_key: (r.first_run, r.last_run, r.active) for r in pu.ledger(first, o("b", "c"), "r2").collect()}
    assert rows == {"a": ("r1", "r1", False), "b": ("r1", "r2", True), "c": ("r2", "r2", True)}
    d = spark.createDataFrame([("2024-01-02", 5), ("2024-01-01", 3)], "k string, v long")
    want = hashlib.sha256(b"2024-01-01\x003\n2024-01-02\x005\n").hexdigest()
    assert li.small_series_digest(d, F.col("k"), F.col("v")).first().digest == want
    big = [li.series_digest(x, F.col("k"), F.col("v")).first().digest for x in (d, d.orderBy("k"), d.withColumn("v", F.col("v") + 1))]
    assert big[0] == big[1] != big[2]


def test_streaming_equals_batch(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    write(src / "1.jsonl", event("a", at=90_000), event("b", at=90_001), "{bad")
    stream = lambda: ingest.deduplicated(ingest.events(ingest.lines(spark, str(src), 1)))
    run = lambda: (ingest.products(stream(), out + "/p", out + "/cp").awaitTermination(120), ingest.segments(stream(), out + "/s", out + "/cs").awaitTermination(120), ingest.shadow(stream(), out + "/h", out + "/ch").awaitTermination(120))
    run()
    # A repeat, a late event of an earlier day, a new one.
    write(src / "2.jsonl", event("a", at=90_000), event("late", at=10), event("c", at=90_002))
    run()
    run()
    got = sorted((str(r.day), r.kind, r.event_count) for r in ingest.read_products(spark, out + "/p").collect())
    assert got == [("1970-01-01", 1, 1), ("1970-01-02", 1, 3)]
    kept = spark.read.parquet(out + "/s")
    assert kept.count() == spark.read.parquet(out + "/h").count() == 4 == kept.select("id").distinct().count()
    assert ingest.position(kept, 90_001) == 90_001 and ingest.position(kept, 5, last=7) == 7
    q = ingest.hourly(stream()).writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.hour_start, r.events) for r in spark.table("hours").collect()) == [(0, 1), (90_000, 3)]
    bounded = ingest.deduplicated_within(ingest.events(ingest.lines(spark, str(src))), "1 hour").writeStream.format("memory").queryName("bounded").trigger(availableNow=True).start()
    bounded.awaitTermination(120)
    assert spark.table("bounded").select("id").distinct().count() == spark.table("bounded").count()


def test_sketches_are_near(spark):
    from eventide.operators import sketches as sk

    e = spark.range(20_000).select((F.col("id") % 4).alias("day"), (F.col("id") % 5000).alias("pubkey"))
    whole = sk.estimated(sk.merged(sk.states(e, F.col("day")))).first()
    assert abs(whole.distinct_items - 5000) < 250 and whole.event_count == 20_000
    assert abs(sk.approximate(e, F.lit(1)).first().distinct_items - 5000) < 500


def test_archive_takes_each_id_once(spark, tmp_path):
    """Repeats in and across batches, a batch that runs again, files by size."""
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    write(src / "1.jsonl", event("a", at=90_000), event("a", at=90_000), event("b", at=90_001))
    stream = lambda: ingest.events(ingest.lines(spark, str(src), 1))
    run = lambda cp: ingest.archive(stream(), out, str(tmp_path / cp), most_bytes=400).awaitTermination(120)
    run("c")
    write(src / "2.jsonl", event("b", at=90_001), event("late", at=10), *[event("x" * 50 + str(i), at=200_000 + i) for i in range(5)])
    run("c")
    kept = spark.read.parquet(out + "/segments")
    assert kept.count() == 8 == kept.select("id").distinct().count() and kept.where("batch = 1").select("part").distinct().count() > 2
    assert ingest.pending(spark, out) == [] and spark.read.parquet(out + "/archived").count() == 8
    # Both batches run again from a lost checkpoint.
    run("other")
    kept = spark.read.parquet(out + "/segments")
    assert kept.count() == 8 == kept.select("id").distinct().count()
