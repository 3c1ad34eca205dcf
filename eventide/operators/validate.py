"""Checks of events: form, id, signature, order, and one row for each id."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.tags import has_empty

HEX = "^[0-9a-f]{%d}$"


def event_json(pubkey: Column, created_at: Column, kind: Column, tags: Column, content: Column) -> Column:
    """The text whose SHA-256 is an event's id."""
    quoted = F.to_json(F.array(content))
    return F.concat(F.lit('[0,"'), pubkey, F.lit('",'), created_at.cast("string"), F.lit(","), kind.cast("string"), F.lit(","), F.to_json(tags), F.lit(","), quoted.substr(F.lit(2), F.char_length(quoted) - 2), F.lit("]"))


def event_id(*parts: Column) -> Column:
    return F.sha2(event_json(*parts), 256)


# The curve of BIP-340: fixed values of the public specification.
P = 2**256 - 2**32 - 977
N = 0xFFFFFFFFFFFFFFFFFFFFFFFFFFFFFFFEBAAEDCE6AF48A03BBFD25E8CD0364141
G = (0x79BE667EF9DCBBAC55A06295CE870B07029BFCDB2DCE28D959F2815B16F81798, 0x483ADA7726A3C4655DA4FBFC0E1108A8FD17B448A68554199C47D08FFB10D4B8)


def _double(p):
    x, y, z = p
    if not y:
        return (0, 1, 0)
    s, m = 4 * x * y * y % P, 3 * x * x % P
    u = (m * m - 2 * s) % P
    return u, (m * (s - u) - 8 * y**4) % P, 2 * y * z % P


def _add(p, q):
    """Points in Jacobian coordinates; z = 0 is the point at infinity."""
    if not p[2] or not q[2]:
        return q if not p[2] else p
    (x1, y1, z1), (x2, y2, z2) = p, q
    a, b = z1 * z1 % P, z2 * z2 % P
    u1, u2, s1, s2 = x1 * b % P, x2 * a % P, y1 * b * z2 % P, y2 * a * z1 % P
    if u1 == u2:
        return _double(p) if s1 == s2 else (0, 1, 0)
    h, r = u2 - u1, s2 - s1
    h2 = h * h % P
    h3, v = h2 * h % P, u1 * h2 % P
    x = (r * r - h3 - 2 * v) % P
    return x, (r * (v - x) - s1 * h3) % P, h * z1 * z2 % P


def _times(p, k: int):
    out = (0, 1, 0)
    for bit in bin(k)[2:]:
        out = _double(out)
        if bit == "1":
            out = _add(out, p)
    return out


def _affine(p):
    if not p[2]:
        return None
    i = pow(p[2], -1, P)
    return p[0] * i * i % P, p[1] * i**3 % P


def _lift(x: int):
    square = (pow(x, 3, P) + 7) % P
    y = pow(square, (P + 1) // 4, P)
    if x >= P or y * y % P != square:
        return None
    return x, y if y % 2 == 0 else P - y


def _tagged(tag: str, data: bytes) -> bytes:
    t = hashlib.sha256(tag.encode()).digest()
    return hashlib.sha256(t + t + data).digest()


def verify_schnorr(message: bytes, key: bytes, signature: bytes) -> bool:
    if len(key) != 32 or len(signature) != 64:
        return False
    point = _lift(int.from_bytes(key, "big"))
    r, s = int.from_bytes(signature[:32], "big"), int.from_bytes(signature[32:], "big")
    if point is None or r >= P or s >= N:
        return False
    e = int.from_bytes(_tagged("BIP0340/challenge", signature[:32] + key + message), "big") % N
    found = _affine(_add(_times((*G, 1), s), _times((*point, 1), N - e)))
    return found is not None and found[1] % 2 == 0 and found[0] == r


def _sum_of(points: list, scalars: list[int]):
    """The sum of all points times their scalars, a window of bits at a time: points that share a window's digit are added up first."""
    width = max(2, len(points).bit_length() - 2)
    out, bits = (0, 1, 0), max((k.bit_length() for k in scalars), default=0)
    for at in range((bits + width - 1) // width * width - width, -1, -width):
        for _ in range(width):
            out = _double(out)
        buckets: list = [None] * (1 << width)
        for p, k in zip(points, scalars, strict=True):
            digit = k >> at & (1 << width) - 1
            if digit:
                buckets[digit] = p if buckets[digit] is None else _add(buckets[digit], p)
        run = total = (0, 1, 0)
        for b in reversed(buckets[1:]):
            run = run if b is None else _add(run, b)
            total = _add(total, run)
        out = _add(out, total)
    return out


def _parsed(message: bytes, key: bytes, signature: bytes):
    """The signature's point, its number, the challenge and the key's point; None where one of them isn't valid by itself."""
    if len(key) != 32 or len(signature) != 64:
        return None
    r, s = int.from_bytes(signature[:32], "big"), int.from_bytes(signature[32:], "big")
    own, point = _lift(r), _lift(int.from_bytes(key, "big"))
    if own is None or point is None or s >= N:
        return None
    return own, s, int.from_bytes(_tagged("BIP0340/challenge", signature[:32] + key + message), "big") % N, point


def _holds(items: list) -> bool:
    """Whether a random combination of the signatures' equations holds: of wrong ones with a chance of 2**-128 at most."""
    seed = hashlib.sha256(b"".join(x[1].to_bytes(32, "big") + x[0][0].to_bytes(32, "big") + x[2].to_bytes(32, "big") + x[3][0].to_bytes(32, "big") for x in items)).digest()
    points, scalars, keys, base = [], [], {}, 0
    for i, (own, s, e, key) in enumerate(items):
        a = 1 if i == 0 else int.from_bytes(hashlib.sha256(seed + i.to_bytes(8, "big")).digest()[:16], "big") | 1
        points.append((own[0], P - own[1], 1))
        scalars.append(a)
        # Signatures of one key share a point.
        keys[key] = (keys.get(key, 0) + a * e) % N
        base = (base + a * s) % N
    points += [(x, P - y, 1) for x, y in keys] + [(*G, 1)]
    return not _sum_of(points, [*scalars, *keys.values(), base])[2]


def verify_batch(signed: list[tuple[bytes, bytes, bytes]]) -> list[bool]:
    """Of (message, key, signature) each whether it is right: together, and by halves where a batch doesn't hold."""
    parsed = [_parsed(*x) for x in signed]
    out = [False] * len(signed)
    todo = [[i for i, p in enumerate(parsed) if p is not None]]
    while todo:
        part = todo.pop()
        if len(part) == 1:
            out[part[0]] = verify_schnorr(*signed[part[0]])
        elif part and _holds([parsed[i] for i in part]):
            for i in part:
                out[i] = True
        elif part:
            todo += [part[: len(part) // 2], part[len(part) // 2 :]]
    return out


def sign_schnorr(message: bytes, secret: int, aux: bytes = bytes(32)) -> tuple[bytes, bytes]:
    """Public key and signature; for tests and tools, not hardened."""
    x, y = _affine(_times((*G, 1), secret))
    d, key = secret if y % 2 == 0 else N - secret, x.to_bytes(32, "big")
    t = (d ^ int.from_bytes(_tagged("BIP0340/aux", aux), "big")).to_bytes(32, "big")
    k = int.from_bytes(_tagged("BIP0340/nonce", t + key + message), "big") % N
    rx, ry = _affine(_times((*G, 1), k))
    k = k if ry % 2 == 0 else N - k
    e = int.from_bytes(_tagged("BIP0340/challenge", rx.to_bytes(32, "big") + key + message), "big") % N
    return key, rx.to_bytes(32, "big") + ((k + e * d) % N).to_bytes(32, "big")


#: Signatures that are verified together.
TOGETHER = 256


@F.pandas_udf(T.BooleanType())
def signature_ok(ids: pd.Series, keys: pd.Series, signatures: pd.Series) -> pd.Series:
    """Of hexadecimal columns, in batches. check() only runs it where it is asked for."""

    def raw(i, k, s):
        try:
            return bytes.fromhex(i), bytes.fromhex(k), bytes.fromhex(s)
        except (ValueError, TypeError):
            return b"", b"", b""

    signed = [raw(*x) for x in zip(ids, keys, signatures, strict=True)]
    out: list[bool] = []
    for a in range(0, len(signed), TOGETHER):
        out += verify_batch(signed[a : a + TOGETHER])
    return pd.Series(out, dtype="boolean")


def check(rows: DataFrame, signatures: bool = False) -> DataFrame:
    """rows of hexadecimal events with status: ok, or the first rule that they break."""
    c = F.col
    hexed = lambda n, size: c(n).isNull() | ~c(n).rlike(HEX % size)
    missing = c("id").isNull() | c("pubkey").isNull() | c("created_at").isNull() | c("kind").isNull() | c("tags").isNull() | c("content").isNull() | c("sig").isNull()
    made = event_id(c("pubkey"), c("created_at"), c("kind"), c("tags"), c("content"))
    status = (
        F.when(missing, "missing_field").when(hexed("id", 64) | hexed("pubkey", 64) | hexed("sig", 128), "bad_hex").when((c("kind") < 0) | (c("kind") > 65535), "bad_kind")
        .when(c("created_at") < 0, "bad_time").when(has_empty(c("tags")), "empty_tag").when(made != c("id"), "bad_id")
    )
    out = rows.withColumn("status", status.otherwise("ok"))
    if signatures:
        good = F.when(c("status") == "ok", signature_ok("id", "pubkey", "sig"))
        out = out.withColumn("status", F.when((c("status") == "ok") & ~F.coalesce(good, F.lit(False)), "bad_signature").otherwise(c("status")))
    return out


def status_counts(checked: DataFrame) -> DataFrame:
    return checked.groupBy("status").agg(F.count("*").alias("n"))


def one_per_id(events: DataFrame) -> DataFrame:
    """One row for each id; of several signatures the smallest."""
    rest = [c for c in events.columns if c != "id"]
    return events.groupBy("id").agg(F.min_by(F.struct(*rest), "sig").alias("x")).select("id", "x.*").select(events.columns)


def canonical_faults(lake: DataFrame) -> DataFrame:
    """Counts of broken rules in lake rows (binary ids, unsigned seconds): nulls, sizes, kinds, empty tags, repeated ids, wrong ids. One row; all zero is canonical."""
    c = F.col
    plain = lake.select(F.lower(F.hex("id")).alias("id"), F.lower(F.hex("pubkey")).alias("pubkey"), F.lower(F.hex("sig")).alias("sig"), "created_at", "kind", "tags", "content")
    null = c("id").isNull() | c("pubkey").isNull() | c("sig").isNull() | c("created_at").isNull() | c("kind").isNull() | c("tags").isNull() | c("content").isNull()
    size = (F.length("id") != 64) | (F.length("pubkey") != 64) | (F.length("sig") != 128)
    made = event_id(c("pubkey"), c("created_at"), c("kind"), c("tags"), c("content"))
    counts = plain.agg(F.count_if(null).alias("nulls"), F.count_if(size).alias("sizes"), F.count_if(~c("kind").between(0, 65535)).alias("kinds"), F.count_if(has_empty(c("tags"))).alias("empty_tags"), F.count_if(made != c("id")).alias("ids"))
    twice = plain.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").agg(F.coalesce(F.sum(c("n") - 1), F.lit(0)).cast("bigint").alias("repeats"))
    return counts.join(F.broadcast(twice))


def file_order_faults(lake: DataFrame) -> DataFrame:
    """Rows of a file that don't come behind their predecessor by (created_at, id), by file; rows are compared in the order of the file."""
    from pyspark.sql import Window

    placed = lake.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    own = F.struct("created_at", "id")
    before = F.lag(own).over(Window.partitionBy("_file").orderBy("_row"))
    return placed.withColumn("_before", before).where(F.col("_before") >= own).groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("faults"))
