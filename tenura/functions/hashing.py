"""Repeatable randomness: the same key and seed give the same number on any partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = float(2**32)


def hash_text(key: Column, seed: int | str) -> Column:
    """32 hex digits of md5 over ``seed:key``; a total random order of the keys."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def uniform(key: Column, seed: int | str) -> Column:
    """Uniform number in [0, 1) from the first eight hex digits of the hash."""
    return F.conv(F.substring(hash_text(key, seed), 1, 8), 16, 10).cast("double") / F.lit(_SPAN)


def pseudonym(value: Column, salt: str) -> Column:
    """One-way replacement of an identifier (sha-256 with a salt)."""
    return F.sha2(F.concat(F.lit(salt), value.cast("string")), 256)
