"""Seeded hashes. Every random choice is a hash of (seed, purpose, id).

Unlike ``rand()`` or ``randomSplit`` the result depends on the row only, so it
survives repartitioning, task retries and a change of cluster size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 60
BUCKET_BITS = 16
DEFAULT_SEED = 42


def seeded_hash(salt: str | int, key: Column | str) -> Column:
    """Uniform non-negative 60-bit integer."""
    key = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def unit_draw(salt: str | int, key: Column | str) -> Column:
    """Uniform double in [0, 1)."""
    return seeded_hash(salt, key).cast("double") / F.lit(float(1 << HASH_BITS))


def hash_bucket(hashed: Column | str) -> Column:
    """The top bits of a hash: equal-sized buckets that keep the hash order."""
    hashed = F.col(hashed) if isinstance(hashed, str) else hashed
    return F.shiftright(hashed, HASH_BITS - BUCKET_BITS).cast("int")
