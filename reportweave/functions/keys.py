"""Repeatable random keys.

A row's key depends on the seed and its id only, so a sample is the same on every run, for
every partitioning and after a lost executor.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKET_DIGITS = 4
BUCKETS = 16**BUCKET_DIGITS


def sample_key(seed: int | str, *ids: Column) -> Column:
    """Hexadecimal digest of seed and ids."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[i.cast("string") for i in ids]).cast("binary"))


def key_number(key: Column) -> Column:
    """First 32 bits of a key as a number."""
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint")


def uniform(seed: int | str, *ids: Column) -> Column:
    """Number in [0, 1) from the key."""
    return key_number(sample_key(seed, *ids)) / F.lit(float(2**32))


def key_bucket(key: Column) -> Column:
    """One of 65,536 equally likely buckets, in key order."""
    return F.conv(F.substring(key, 1, BUCKET_DIGITS), 16, 10).cast("int")
