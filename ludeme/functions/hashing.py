"""Deterministic hash buckets that a SQL engine can reproduce exactly.

bucket = int(first 8 hex digits of md5('<seed>|<key>|...'), 16) mod BUCKETS

The same row lands in the same bucket whatever the file layout, partition
count or retry, unlike ``randomSplit`` whose output depends on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 1_000_000  # the finest share of a split


def hash_bucket(key_cols: Sequence[str], seed: int | str = 42, buckets: int = BUCKETS) -> Column:
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") for c in key_cols]
    hex8 = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.pmod(F.conv(hex8, 16, 10).cast("long"), F.lit(buckets))


def salt(cols: Sequence[str], n: Column) -> Column:
    """Deterministic salt in [0, n) from a row's own values (retry-safe, unlike rand)."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in cols]), n.cast("long")).cast("int")
