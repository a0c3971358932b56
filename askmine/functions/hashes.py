"""Digests as column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The split's seed and share.
SEED, SHARE = 42, 0.10


def split_rank(key: Column, seed: int = SEED) -> Column:
    """A reproducible number in [0, 1) for a thread; a null key counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("double") / F.lit(float(1 << 64))


def is_held_out(key: Column, seed: int = SEED, share: float = SHARE) -> Column:
    return split_rank(key, seed) < F.lit(share)


def plain_hash(value: Column) -> Column:
    """16 hex digits of SHA-256 of the trimmed value; empty for empty."""
    clean = F.trim(F.coalesce(value, F.lit("")))
    return F.when(clean == "", F.lit("")).otherwise(F.substring(F.sha2(clean, 256), 1, 16))


def keyed_hash(value: Column, key: bytes) -> Column:
    """16 hex digits of HMAC-SHA-256 of the trimmed value in lower case; empty for empty."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner, outer = (F.lit(bytes(b ^ pad for b in block)) for pad in (0x36, 0x5C))
    clean = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    first = F.unhex(F.sha2(F.concat(inner, F.encode(clean, "utf-8")), 256))
    return F.when(clean == "", F.lit("")).otherwise(F.substring(F.sha2(F.concat(outer, first), 256), 1, 16))


def body_fingerprint(subject: Column, body: Column) -> Column:
    clean = F.trim(F.regexp_replace(F.lower(body), r"(?U)[\s\x1c-\x1f]+", " "))
    return F.sha2(F.concat(F.lower(F.trim(subject)), F.lit("\0"), clean), 256)
