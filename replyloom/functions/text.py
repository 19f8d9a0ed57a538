"""Column functions over reply and request text (all inside code generation)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from replyloom.domain import INTENTS

# What Python's str.strip() removes, and the reply punctuation set.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
JSON_WHITESPACE = " \t\n\r"
REPLY_PUNCTUATION = ".!?:;\"'`"


def strip(c: Column) -> Column:
    """Unicode strip; ``trim`` alone only removes U+0020."""
    return F.btrim(c, F.lit(PY_WHITESPACE))


def normalize_reply(c: Column) -> Column:
    """strip, then punctuation off both ends, then lower; no second strip."""
    return F.lower(F.btrim(strip(c), F.lit(REPLY_PUNCTUATION)))


def strict_format(c: Column, classes=INTENTS) -> Column:
    """The stripped reply is exactly a class name: case and punctuation count."""
    return F.coalesce(strip(c).isin(*classes), F.lit(False))


def in_domain(c: Column, classes=INTENTS) -> Column:
    return F.coalesce(c.isin(*classes), F.lit(False))


def _names(classes) -> Column:
    return F.array(*[F.lit(c) for c in classes])


def domain_code(c: Column, classes=INTENTS) -> Column:
    """Class position from 1, 0 when outside: a fixed-width stand-in, so that
    per-request aggregation can hash instead of sort."""
    return F.coalesce(F.array_position(_names(classes), c), F.lit(0)).cast("int")


def domain_label(code: Column, classes=INTENTS) -> Column:
    """Class at a position; NULL for 0."""
    return F.get(_names(classes), code - 1)


def fingerprint(c: Column) -> Column:
    return F.sha1(F.lower(strip(c)))


def preview(c: Column, n: int = 60) -> Column:
    return F.substring(c, 1, n)


def seeded_hash(seed, key: Column) -> Column:
    """Order key for seeded shuffles and splits: md5 of ``seed:key``."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def murmur3(data: bytes, seed: int = 42) -> int:
    """The signed 32-bit hash by which ``HashingTF`` places a term."""
    mask, h = 0xFFFFFFFF, seed
    for at in range(0, len(data), 4):
        part = data[at : at + 4]
        k = int.from_bytes(part, "little") * 0xCC9E2D51 & mask
        h ^= ((k << 15 | k >> 17) & mask) * 0x1B873593 & mask
        if len(part) == 4:
            h = ((h << 13 | h >> 19) & mask) * 5 + 0xE6546B64 & mask
    h ^= len(data)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h
