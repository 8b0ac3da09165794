"""The k-th smallest value of a column, by counting its digits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIGIT_BITS = 16


def kth_smallest(df: DataFrame, column: str, k: int, bits: int = 64) -> tuple[int, int]:
    """``(value, rest)``: the k-th smallest value of a bigint column without
    NULLs (1-based, k at most the number of rows), and how many of the rows that
    equal it are among the k smallest.

    Exact and independent of k: each pass counts 16-bit digits of the rows that
    agree with the digits found so far (65,536 counts at most on the driver), so
    no sort and no k rows in one task. ``bits`` bounds values that are known to be
    non-negative and smaller than ``2**bits``.
    """
    prefix, shift = None, -(-bits // DIGIT_BITS) * DIGIT_BITS
    while shift:
        shift -= DIGIT_BITS
        rows = df if prefix is None else df.where(F.shiftright(column, shift + DIGIT_BITS) == prefix)
        counts = rows.groupBy(F.shiftright(column, shift).alias("d")).agg(F.count(F.lit(1)).alias("c")).collect()
        for row in sorted(counts, key=lambda r: r["d"]):
            if row["c"] >= k:
                prefix = row["d"]
                break
            k -= row["c"]
    return prefix, k
