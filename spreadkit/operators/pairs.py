"""Point-set checks, rows of groups, and all pairs of a small set.

Average distance and greedy matching are defined over all pairs; they are meant
for coresets and solutions, whose size does not follow the input. Rows are
hashed into blocks and copied to the block pairs they belong to, so the pairs
come from an equi-join on the block pair and no task holds more than one pair of
blocks at a time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Rows of a block: one pair of blocks is at most 2.7e8 pairs.
MAX_BLOCK_ROWS = 16384
# Copies of a group's row when it can't be broadcast.
SALTS = 64


class PointSetError(ValueError):
    """A point set that cannot be measured (for example mixed dimensions)."""


def bad_vector_sql(vec: str = "vec") -> str:
    """SQL condition for a vector no distance can be computed from."""
    return (
        f"`{vec}` IS NULL OR exists(`{vec}`, x -> x IS NULL OR isnan(x) "
        "OR abs(x) = CAST('Infinity' AS DOUBLE))"
    )


def point_checks(vec: str = "vec") -> list[Column]:
    """Aggregates ``n, dmin, dmax, bad`` that :func:`check_point_stats` reads."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.min(F.size(vec)).alias("dmin"),
        F.max(F.size(vec)).alias("dmax"),
        F.expr(f"count_if({bad_vector_sql(vec)})").alias("bad"),
    ]


def check_point_stats(n: int, dmin, dmax, bad: int) -> None:
    """Raise for NULL / non-finite vectors or mixed dimensions."""
    if bad:
        raise PointSetError(f"{bad} points have a NULL vector or a non-finite coordinate")
    if n and dmin != dmax:
        raise PointSetError(f"points have different dimensions ({dmin} to {dmax})")


def point_stats(points: DataFrame, vec: str = "vec") -> tuple[int, int]:
    """``(n, dim)`` in one pass; raises if rows disagree on the dimension or
    a vector is NULL or holds a NULL, NaN or infinite coordinate."""
    row = points.agg(*point_checks(vec)).first()
    check_point_stats(row["n"], row["dmin"], row["dmax"], row["bad"])
    return row["n"], row["dmin"] or 0


def self_pairs(points: DataFrame, n: int, order: str = "id", block_rows: int = MAX_BLOCK_ROWS) -> DataFrame:
    """Every unordered pair of rows once: columns ``<c>_i`` and ``<c>_j`` with
    ``order_i < order_j``; ``order`` is unique per row."""
    blocks = max(1, math.ceil(n / block_rows))
    block = F.pmod(F.xxhash64(F.col(order)), F.lit(blocks)).cast("int")
    side = points.withColumn("__b", block)
    left = side.select(
        *[F.col(c).alias(f"{c}_i") for c in points.columns], F.col("__b").alias("__bi"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("__bj"),
    )
    right = side.select(
        *[F.col(c).alias(f"{c}_j") for c in points.columns], F.col("__b").alias("__bj"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("__bi"),
    )
    # the pair's earlier row stands on the left, whichever block it is in
    joined = left.join(right, ["__bi", "__bj"]).where(F.col(f"{order}_i") < F.col(f"{order}_j"))
    return joined.drop("__bi", "__bj")


def with_group_row(state: DataFrame, rows: DataFrame, small: bool) -> DataFrame:
    """Join one row per group to the points of the group."""
    if small:
        return state.join(F.broadcast(rows), "g")
    salted = rows.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = state.withColumn("__salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return own.join(salted, ["g", "__salt"]).drop("__salt")
