"""Segments read by stretches against the whole; signatures in batches against one by one."""

import gzip
import hashlib
import time

import pytest
from test_sources import SECRET, event

from eventide.operators import validate as va
from eventide.sources import files as fi


def test_stretches_are_the_whole(spark, tmp_path):
    seg = tmp_path / "seg"
    seg.mkdir()
    notes = [fi.encode_note(event("x" * (i * 37 % 900), at=i)) for i in range(300)]
    framed = b"".join(len(m).to_bytes(4, "little") + m for m in notes)
    (seg / "a.seg").write_bytes(framed + (3).to_bytes(4, "little") + b"\xff\xff\xff" + framed)
    (seg / "b.seg").write_bytes(framed[:-5])  # cut off
    (seg / "c.gz").write_bytes(gzip.compress(framed))
    (seg / "d.seg").write_bytes(framed + (1 << 30).to_bytes(4, "little") + b"rest")  # too large a frame
    (seg / "e.seg").write_bytes(b"")
    index = fi.frame_index(spark, str(seg), every=20_000)
    index.write.parquet(str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    per = {r.path.rpartition("/")[2]: r["count"] for r in index.groupBy("path").count().collect()}
    assert per["a.seg"] > 10 and per["c.gz"] == per["e.seg"] == 1 and per["b.seg"] > 5
    whole, split = fi.segments(spark, str(seg), salvage=True), fi.indexed_segments(index, salvage=True)
    names = ["offset", "id", "created_at", "content", "payload", "status"]
    rows = lambda s: sorted(((r.path.rpartition("/")[2], *[r[n] for n in names]) for r in s.rows.collect()), key=str)
    assert rows(whole) == rows(split) and {"ok", "truncated", "oversize", "invalid_message"} == {r[-1] for r in rows(split)}
    with pytest.raises(ValueError, match="cut off"):
        fi.indexed_segments(index)
    (seg / "b.seg").write_bytes(framed)
    with pytest.raises(Exception, match="when it was indexed"):
        fi.indexed_segments(index, salvage=True).rows.count()


def signed(n):
    out = []
    for i in range(n):
        message = hashlib.sha256(bytes([i])).digest()
        out.append((message, *va.sign_schnorr(message, SECRET + i % 5)))
    return out


def test_batches_find_the_faulty():
    items = signed(40)
    assert va.verify_batch(items) == [True] * 40 and va.verify_batch([]) == []
    bad = list(items)
    flip = lambda b, at: b[:at] + bytes([b[at] ^ 1]) + b[at + 1 :]
    bad[3] = (flip(items[3][0], 0), *items[3][1:])
    bad[17] = (items[17][0], items[17][1], flip(items[17][2], 63))
    bad[18] = (items[18][0], b"\xff" * 32, items[18][2])
    bad[30] = (items[30][0], items[31][1], items[30][2])
    bad[39] = (items[39][0], items[39][1], items[39][2][:-1])
    assert va.verify_batch(bad) == [va.verify_schnorr(*x) for x in bad] == [i not in (3, 17, 18, 30, 39) for i in range(40)]


def test_published_vectors():
    """Of the signature scheme's own vectors: two that are right, and three that are not."""
    x = bytes.fromhex
    key = x("DFF1D77F2A671C5F36183726DB2341BE58FEAE1DA2DECED843240F7B502BA659")
    message = x("243F6A8885A308D313198A2E03707344A4093822299F31D0082EFA98EC4E6C89")
    good = [
        (bytes(32), x("F9308A019258C31049344F85F89D5229B531C845836F99B08601F113BCE036F9"), x("E907831F80848D1069A5371B402410364BDF1C5F8307B0084C55F1CE2DCA821525F66A4A85EA8B71E482A74F382D2CE5EBEEE8FDB2172F477DF4900D310536C0")),
        (message, key, x("6896BD60EEAE296DB48A229FF71DFE071BDE413E6D43F917DC8DCF8C78DE33418906D11AC976ABCCB20B091292BFF4EA897EFCB639EA871CFA95F6DE339E4B0A")),
    ]
    wrong = [
        (message, x("EEFDEA4CDB677750A420FEE807EACF21EB9898AE79B9768766E4FAA04A2D4A34"), good[1][2]),  # a key that is no point
        (message, key, good[1][2][:32] + bytes([good[1][2][32] ^ 255]) + good[1][2][33:]),
        (message, key, bytes(32) + good[1][2][32:]),
    ]
    assert va.verify_batch(good) == [True, True] and va.verify_batch([*good, *wrong]) == [True, True, False, False, False]


def test_batches_are_faster():
    items = signed(96)
    began = time.process_time()
    assert all(va.verify_batch(items))
    together = time.process_time() - began
    began = time.process_time()
    assert all(va.verify_schnorr(*x) for x in items)
    assert together < (time.process_time() - began) / 2
