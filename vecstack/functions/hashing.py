"""Portable, seedable pseudo-randomness.

Every random choice of the engine (fold order, bootstrap weights, subsamples,
per-node feature subsets) is a pure function of a seed and row / node keys, so
it is the same on every executor, after any retry, and for every partitioning.
The hash is the first 32 bits of an MD5 digest, which DuckDB computes
identically: ``('0x' || substr(md5(s), 1, 8))::BIGINT``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = float(1 << 32)


def _key(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def portable_hash(*parts) -> Column:
    """Unsigned 32-bit hash of ``concat_ws(':', parts)`` as BIGINT."""
    return F.conv(F.substring(F.md5(_key(*parts)), 1, 8), 16, 10).cast("bigint")


def sql_hash(expr: str) -> str:
    """DuckDB spelling of the hash of a VARCHAR expression."""
    return f"('0x' || substr(md5({expr}), 1, 8))::BIGINT"
