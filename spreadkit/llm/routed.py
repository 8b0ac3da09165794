"""Totals of unbounded keys brought back to rows: the frequent keys by a table of
bounded size on every worker, the rest by a join.

A corpus has any number of distinct words or id pairs, so their totals can't be
broadcast; but a few hundred thousand of them make up most occurrences. The
border is chosen by counting totals in ranges, so that at most ``limit`` keys lie
above it. Below it a key has few occurrences, so the join has no hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# ranges of totals for one doubling
_STEPS = 8
ABOVE_ALL = 1 << 62


def border(totals: DataFrame, column: str, limit: int) -> int:
    """The least total such that at most ``limit`` rows have it or more (ranges of
    totals are taken whole)."""
    bucket = F.floor(F.log2(F.col(column).cast("double")) * _STEPS).cast("int")
    rows = totals.where(F.col(column) > 0).groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.min(column).alias("least")
    ).collect()  # at most 8 rows for a doubling: 512 in all
    taken, least = 0, None
    for row in sorted(rows, key=lambda r: -r.bucket):
        taken += row.n
        if taken > limit:
            break
        least = row.least
    return least if least is not None else ABOVE_ALL
