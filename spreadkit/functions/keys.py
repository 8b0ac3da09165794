"""Key expressions: bucket, salt and seeded rank."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket(key: Column | str, k: int) -> Column:
    """``key % k`` with the sign of the dividend (``-7 % 3 = -1``), as in Java."""
    if k < 1:
        raise ValueError("the number of buckets must be positive")
    return _col(key) % F.lit(k)


def partition_number(key: Column | str, k: int) -> Column:
    """``pmod(key, k)``: a partition number in ``[0, k)``, for negative keys too."""
    if k < 1:
        raise ValueError("the number of partitions must be positive")
    return F.pmod(_col(key), F.lit(k))


def salt(k: int, *cols: Column | str) -> Column:
    """Deterministic salt in ``[0, k)`` from a hash of ``cols``.

    A random salt would make a retried task send rows to other reducers than
    the first attempt did; a hash of the row's own values does not.
    """
    if k < 1:
        raise ValueError("the number of salts must be positive")
    return F.pmod(F.xxhash64(*[_col(c) for c in cols]), F.lit(k)).cast("int")


def seeded_rank(seed: int, key: Column | str) -> Column:
    """The first 60 bits of the MD5 of ``'<seed>:<key>'``, as a bigint: a
    seeded, order-free rank.

    The smallest ranks are the same uniform sample on every run and on every
    engine that has ``md5``.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), _col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
