"""Deterministic surrogate keys.

``md5`` form: the first 16 hex digits of md5(text) read as a signed 64-bit integer, the full width of a bigint key;
an independent engine computes the same value. ``xxhash64`` form: Spark's 64-bit hash, faster, Spark-only.
Dimensions keep the natural key beside the surrogate, joins inside the engine use the natural key, and the
data-quality ``unique`` test on both keys reports a collision.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(col, algo: str = "md5") -> Column:
    c = F.col(col) if isinstance(col, str) else col
    s = c.cast("string")
    if algo == "md5":
        return F.conv(F.substring(F.md5(s), 1, 16), 16, -10).cast("bigint")
    if algo == "xxhash64":
        return F.xxhash64(s)
    raise ValueError(f"unknown surrogate key algorithm {algo!r}")


def hashed_id(col, salt: str = "") -> Column:
    """One-way anonymisation of a natural id (sha-256 hex), optional salt."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sha2(F.concat(F.lit(salt), c.cast("string")), 256)
