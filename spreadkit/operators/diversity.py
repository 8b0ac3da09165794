"""Diversity maximisation: greedy matching and the two-round plan (M1-M3).

Greedy matching (the sequential 2-approximation for max-sum diversity):
``k // 2`` times take the farthest pair of points not yet taken; for odd
``k`` add the first remaining point; ``k >= n`` returns every point. Ties are
broken by a caller-given order column: the pair ``(i, j)`` with ``i`` before
``j`` that comes first in ``(distance desc, order_i, order_j)`` wins, and a
pair is listed with its earlier point first. Unlike the reference, two
distinct unused points are always taken, also when all distances are 0.

The two-round plan reduces each of ``L`` groups to its ``k`` farthest-first
centers (the coreset) and runs the matching on the ``k * L`` coreset points,
ordered by ``(group, step)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spreadkit.functions.keys import partition_number
from spreadkit.functions.vectors import sqdist
from spreadkit.operators.centers import farthest_first
from spreadkit.operators.geometry import avg_pairwise_distance
from spreadkit.operators.pairs import point_stats, self_pairs
from spreadkit.runtime import cached, fits_broadcast, stored


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df.sparkSession, rows, 48) else df


def _edge_key(edge) -> tuple:
    """Total order of a pair, larger is better: distance, then earlier ends."""
    return (edge["d2"], -edge["o_i"], -edge["o_j"])


def _matching(pairs: DataFrame, half: int, id_type: str) -> list:
    """The first ``half`` pairs of the greedy matching, by rounds of locally
    dominant pairs.

    A pair that is the best pair of both its points is in the greedy matching;
    after taking all of them and removing their points, the next round finds the
    next ones. Pairs found so far that beat every pair still possible are exactly
    the top greedy pairs, so the loop stops as soon as ``half`` of them are
    confirmed. A round is one pass over the pairs plus an aggregate with one row
    per point; at most ``half`` pairs of it reach the driver.
    """
    found: list = []
    live = pairs
    edge = F.struct(
        "d2", (-F.col("o_i")).alias("n_i"), (-F.col("o_j")).alias("n_j"), "o_i", "o_j", "id_i", "id_j"
    )
    while True:
        per_point = live.select(F.explode(F.array("id_i", "id_j")).alias("v"), edge.alias("e"))
        best = per_point.groupBy("v").agg(F.max("e").alias("e"))
        mutual = best.groupBy("e").agg(F.count(F.lit(1)).alias("ends")).where("ends = 2")
        top = [r["e"] for r in mutual.orderBy(F.col("e").desc()).limit(half).collect()]
        if not top:
            break  # fewer than two unused points are left
        confirmed = [e for e in found if _edge_key(e) > _edge_key(top[0])]
        if len(confirmed) >= half:
            break
        found += top
        ids = [(x,) for e in found for x in (e["id_i"], e["id_j"])]
        used = pairs.sparkSession.createDataFrame(ids, f"used {id_type}")
        live = pairs
        for end in ("id_i", "id_j"):
            live = live.join(_small(used, len(ids)), F.col(end) == F.col("used"), "left_anti")
    return sorted(found, key=_edge_key, reverse=True)[:half]


def _ranked(pts: DataFrame) -> DataFrame:
    """``pick, id, vec`` of all points in order: sorted by ranges, numbered within
    each range, the ranges' sizes (one row each) added up."""
    ordered = stored(pts.repartitionByRange("o").select("*", F.spark_partition_id().alias("range")), "ranked")
    sizes = ordered.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("range", before.alias("start"))
    rank = F.row_number().over(Window.partitionBy("range").orderBy("o")) - 1
    return ordered.join(starts, "range").select((rank + F.col("start")).cast("int").alias("pick"), "id", "vec")


def greedy_matching(points: DataFrame, k: int, order: str = "id") -> DataFrame:
    """Up to ``k`` points chosen by greedy matching (M1): ``pick, id, vec``.

    ``order`` names a unique numeric column used for tie-breaking and for the
    order of the picks within a pair (default: the id). All pairs are compared,
    so this is for coresets, not for whole tables.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    pts = points.select("id", "vec", F.col(order).alias("o"))
    spark, id_type = pts.sparkSession, pts.schema["id"].dataType.simpleString()
    n, dim = point_stats(pts)
    if k >= n:
        return _ranked(pts)
    pairs = cached(
        self_pairs(pts, n, order="o").select("id_i", "id_j", "o_i", "o_j", sqdist("vec_i", "vec_j", dim).alias("d2"))
    )
    try:
        chosen = _matching(pairs, k // 2, id_type) if k > 1 else []
    finally:
        pairs.unpersist()
    ids = [x for e in chosen for x in (e["id_i"], e["id_j"])]
    picks = spark.createDataFrame(list(enumerate(ids)), f"pick int, id {id_type}")
    if k % 2:
        rest = pts.join(_small(picks.select("id"), len(ids)), "id", "left_anti")
        first = rest.agg(F.min_by("id", "o").alias("id")).first()["id"]
        picks = spark.createDataFrame([*enumerate(ids), (len(ids), first)], f"pick int, id {id_type}")
    return pts.join(_small(picks, len(ids) + 1), "id").select("pick", "id", "vec")


def coreset(points: DataFrame, k: int, groups: int, group: str | None = None) -> DataFrame:
    """Round 1 (F3): ``g, step, id, vec, d2`` for up to ``k`` centers per group.

    Without ``group`` the groups are ``pmod(id, groups)``, a reproducible
    stand-in for the reference's random partitions.
    """
    if groups < 1:
        raise ValueError("the number of groups must be at least 1")
    g = F.col(group) if group else partition_number("id", groups)
    pts = points.select(g.cast("bigint").alias("g"), "id", "vec")
    return farthest_first(pts, k, group="g")


def diversify(points: DataFrame, k: int, groups: int, group: str | None = None) -> DataFrame:
    """Two-round diversity maximisation (M2): ``pick, id, vec``.

    Round 1 is :func:`coreset`; round 2 is :func:`greedy_matching` over the
    coreset, ordered by ``(g, step)``. The centers of the rounds are written
    tables, so round 2 does not recompute round 1.
    """
    core = coreset(points, k, groups, group)
    core = core.withColumn("pos", F.col("g") * F.lit(k) + F.col("step"))
    return greedy_matching(core, k, order="pos")


def diversity_value(points: DataFrame, k: int, groups: int, group: str | None = None) -> DataFrame:
    """Average pairwise distance of the two-round solution (M3), one row ``avg_distance``."""
    return avg_pairwise_distance(diversify(points, k, groups, group).select("id", "vec"))
