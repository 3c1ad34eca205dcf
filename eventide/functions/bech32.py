"""Encoded identifiers of events and authors (Bech32 with type-length-value parts)."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the public specification.
ALPHABET = "qpzry9x8gf2tvdw0s3jn54khce6mua7l"
GENERATOR = (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
PLAIN = {"npub": "profile", "note": "event"}
PARTS = {"nprofile": "profile", "nevent": "event", "naddr": "address"}


def _checksum(values: list[int]) -> int:
    state = 1
    for v in values:
        top, state = state >> 25, (state & 0x1FFFFFF) << 5 ^ v
        for i, g in enumerate(GENERATOR):
            if top >> i & 1:
                state ^= g
    return state


def _spread(prefix: str) -> list[int]:
    return [ord(c) >> 5 for c in prefix] + [0] + [ord(c) & 31 for c in prefix]


def _regroup(values, have: int, want: int, fill: bool) -> list[int]:
    bits = "".join(f"{v:0{have}b}" for v in values)
    rest = len(bits) % want
    if rest and fill:
        bits += "0" * (want - rest)
    elif rest:
        if rest >= have or "1" in bits[-rest:]:
            raise ValueError("bad padding")
        bits = bits[:-rest]
    return [int(bits[i : i + want], 2) for i in range(0, len(bits), want)]


def encode(prefix: str, data: bytes) -> str:
    values = _regroup(data, 8, 5, True)
    check = _checksum(_spread(prefix) + values + [0] * 6) ^ 1
    return prefix + "1" + "".join(ALPHABET[v] for v in values + [check >> 5 * (5 - i) & 31 for i in range(6)])


def decode(text: str) -> tuple[str, bytes]:
    if text != text.lower() and text != text.upper():
        raise ValueError("mixed case")
    prefix, mark, rest = text.lower().rpartition("1")
    if not mark or not prefix or len(rest) < 6 or set(rest) - set(ALPHABET):
        raise ValueError("not Bech32")
    values = [ALPHABET.index(c) for c in rest]
    if _checksum(_spread(prefix) + values) != 1:
        raise ValueError("bad checksum")
    return prefix, bytes(_regroup(values[:-6], 5, 8, False))


def parse(identifier: str) -> dict:
    """type (event, profile, address or hex) with hex, or kind, pubkey and d; ValueError if it is none."""
    text = identifier.strip().removeprefix("nostr:")
    if re.fullmatch(r"[0-9a-fA-F]{64}", text):
        return {"type": "hex", "hex": text.lower()}
    prefix, data = decode(text)
    if prefix in PLAIN:
        if len(data) != 32:
            raise ValueError("not 32 bytes")
        return {"type": PLAIN[prefix], "hex": data.hex()}
    if prefix not in PARTS:
        raise ValueError(f"unknown prefix {prefix}")
    parts: dict[int, bytes] = {}
    while len(data) >= 2 and len(data) >= 2 + data[1]:
        parts.setdefault(data[0], data[2 : 2 + data[1]])
        data = data[2 + data[1] :]
    if PARTS[prefix] == "address":
        return {"type": "address", "d": parts[0].decode(), "pubkey": parts[2].hex(), "kind": int.from_bytes(parts[3], "big")}
    if len(parts.get(0, b"")) != 32:
        raise ValueError("not 32 bytes")
    return {"type": PARTS[prefix], "hex": parts[0].hex()}


def compose(prefix: str, *parts: tuple[int, bytes]) -> str:
    """An identifier of parts (type, value)."""
    return encode(prefix, b"".join(bytes([t, len(v)]) + v for t, v in parts))


@F.pandas_udf(T.StringType())
def to_npub(keys: pd.Series) -> pd.Series:
    return keys.map(lambda k: None if k is None else encode("npub", bytes.fromhex(k)))


@F.pandas_udf(T.StringType())
def to_hex(identifiers: pd.Series) -> pd.Series:
    """The hexadecimal id or key of an identifier; null for addresses and for what is none."""

    def one(x):
        try:
            return parse(x).get("hex") if x is not None else None
        except (ValueError, KeyError, IndexError):
            return None

    return identifiers.map(one)
