"""Distances over point sets.

Points are ``id, vec array<double>`` with unique ids; every operator checks once
that all vectors share one dimension. Scalar answers are one-row DataFrames; an
empty input gives NULL, never a sentinel value.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.functions.keys import seeded_rank
from spreadkit.functions.vectors import MAX_UNROLLED_DIM, sqdist, sqdist_sql
from spreadkit.operators import metric_tree
from spreadkit.operators.metric_tree import SLACK
from spreadkit.operators.pairs import (
    MAX_BLOCK_ROWS, PointSetError, bad_vector_sql, check_point_stats, point_checks, point_stats, self_pairs, with_group_row,
)
from spreadkit.operators.select import kth_smallest
from spreadkit.runtime import broadcast_limit, cached, fits_broadcast, stored, vector_row_bytes

DEFAULT_SEED = 1242457

# Centers that cut the set into cells for the exact diameter.
PIVOTS = 4
# Points of a sample that bound its distances (J2), and sizes up to which its
# ranks are sorted on the driver.
SAMPLE_PIVOTS = 2
DRIVER_RANKS = 1 << 16
RANK_RANGE = 1 << 60
# Survivors of the pivots' bounds from which a tree pays for its jobs.
TREE_ROWS = 4096


def _points(points: DataFrame) -> DataFrame:
    return points.select("id", "vec")


def distances_to_center(points: DataFrame, group: str, squared: bool = False) -> DataFrame:
    """``i, j, sqdist`` (or ``distance``): each point ``j`` against the first
    center ``i`` (smallest id) of its group (P6, P7). The centers are broadcast if
    they fit, else copied over salts, so a large group is many tasks' work."""
    pts = points.select(F.col(group).alias("g"), "id", "vec")
    n, dim = point_stats(pts)
    first = pts.groupBy("g").agg(F.min("id").alias("i"), F.min_by("vec", "id").alias("center"))
    d2 = sqdist("vec", "center", dim)
    value = d2.alias("sqdist") if squared else F.sqrt(d2).alias("distance")
    groups = pts.agg(F.approx_count_distinct("g").alias("n")).first()["n"]
    small = fits_broadcast(points.sparkSession, 2 * groups, vector_row_bytes(dim, 3))  # an estimate: twice, to be sure
    return with_group_row(pts, first, small).where("id <> i").select("i", F.col("id").alias("j"), value)


def _farthest(pts: DataFrame, d2: str) -> list[float]:
    """A point with the largest ``d2`` (the smallest id among them): a top-1, in
    which each task keeps its best row."""
    row = pts.select("vec", "id", F.expr(d2).alias("d2")).orderBy(F.desc("d2"), "id").limit(1).first()
    return [float(x) for x in row["vec"]]


def diameter(
    points: DataFrame, pivots: int = PIVOTS, tree_rows: int = TREE_ROWS, leaf_rows: int = metric_tree.LEAF_ROWS
) -> DataFrame:
    """Exact maximum pairwise distance (J1), one row ``diameter``.

    1. A few pivots, from the centroid on always the point farthest from those
       so far; they are the only points the driver holds. One scan gives every
       point's distance to each, and its cell (nearest pivot).
    2. The largest distance from a pivot is a lower bound ``low``.
    3. A point can be an end of a longer pair only if its distance to the
       centroid plus the largest such distance reaches ``low``, and, for some
       cell, its distance to the cell's pivot plus the cell's radius does.
       Radii shrink with the survivors, so this is repeated while it helps.
    4. More than ``tree_rows`` survivors go into a tree of balls, which is
       searched pair of nodes by pair of nodes (see ``metric_tree``). Fewer are
       paired cell by cell, only over cells whose bound reaches ``low``; a large
       cell is split by hash, and pairs come from an equi-join.

    Exact for any data. Where distances concentrate (random points in high
    dimension) no bound helps and all pairs are compared: the definition's own work.
    """
    source = _points(points)
    spark = source.sparkSession
    probe = source.selectExpr("size(vec) AS d").first()
    if probe is None:
        return spark.createDataFrame([(None,)], "diameter double")
    pts = cached(source)
    try:
        means = [F.expr(f"avg(get(vec, {i}))").alias(f"c{i}") for i in range(max(probe["d"] or 0, 0))]
        stats = pts.agg(*point_checks(), *means).first()
        check_point_stats(stats["n"], stats["dmin"], stats["dmax"], stats["bad"])
        dim = stats["dmin"]
        centroid = [float(stats[f"c{i}"]) for i in range(dim)]
        unrolled = dim if dim * (pivots + 1) <= MAX_UNROLLED_DIM else None
        centers = [_farthest(pts, sqdist_sql("vec", centroid, unrolled))]
        while len(centers) < pivots:
            d2 = [sqdist_sql("vec", c, unrolled) for c in centers]
            centers.append(_farthest(pts, f"least({', '.join(d2)})" if len(d2) > 1 else d2[0]))
        return _diameter(pts, centers, centroid, dim, unrolled, tree_rows, leaf_rows)
    finally:
        pts.unpersist()


def _diameter(
    pts: DataFrame, centers: list, centroid: list, dim: int, unrolled: int | None, tree_rows: int, leaf_rows: int
) -> DataFrame:
    spark = pts.sparkSession
    d = [f"sqrt({sqdist_sql('vec', c, unrolled)})" for c in centers]
    scored = pts.selectExpr(
        "id", "vec", f"array({', '.join(d)}) AS d", f"sqrt({sqdist_sql('vec', centroid, unrolled)}) AS r"
    ).selectExpr("*", "cast(array_position(d, array_min(d)) - 1 AS int) AS cell")
    alive = cached(scored)
    try:
        cells = _cells(alive)
        low = max(c["far"] for c in cells.values())
        least = low * (1 - SLACK)
        while True:
            reach = " OR ".join(f"d[{j}] + {c['radius']!r}D >= {least!r}D" for j, c in cells.items())
            widest = max(c["r"] for c in cells.values())
            kept = cached(alive.where(F.expr(f"r + {widest!r}D >= {least!r}D AND ({reach})")))
            before, cells = sum(c["n"] for c in cells.values()), _cells(kept)
            alive.unpersist()
            alive, after = kept, sum(c["n"] for c in cells.values())
            if after > before // 2 or after < 2:
                break
        if after > max(tree_rows, 1):
            low, _ = metric_tree.farthest_pair(alive.select("id", "vec"), dim, low, leaf_rows)
            return spark.createDataFrame([(low,)], "diameter double")
        best = _longest_between_cells(alive, cells, least, dim) if after > 1 else None
        return spark.createDataFrame([(max(low, math.sqrt(best) if best is not None else 0.0),)], "diameter double")
    finally:
        alive.unpersist()


def _cells(alive: DataFrame) -> dict[int, dict]:
    """Size, radius and reach of every cell: at most one row per pivot."""
    rows = alive.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.array_min("d")).alias("radius"), F.max(F.array_max("d")).alias("far"),
        F.max("r").alias("r"),
    ).collect()
    return {r["cell"]: r.asDict() for r in sorted(rows, key=lambda r: r["cell"])}


def _longest_between_cells(alive: DataFrame, cells: dict[int, dict], least: float, dim: int) -> float | None:
    """Largest squared distance of a pair whose cells and own distances allow
    one of at least ``least``."""
    parts = {j: math.ceil(c["n"] / MAX_BLOCK_ROWS) for j, c in cells.items()}
    own = alive.withColumn("part", F.pmod(F.xxhash64("id"), _by_cell(parts)).cast("int"))
    # a point goes to every part of each cell it may have a partner in
    targets = F.array_compact(F.array(*[
        F.when(F.expr(f"d[{j}] + {c['radius']!r}D >= {least!r}D"), F.lit(j)) for j, c in cells.items()
    ]))
    sent = own.select("id", "vec", "cell", "part", F.explode(targets).alias("to"))
    sent = sent.select("*", F.explode(F.sequence(F.lit(0), _by_cell(parts, "to") - 1)).alias("to_part"))
    left = sent.where("struct(cell, part) <= struct(to, to_part)").selectExpr(
        "id AS id_i", "vec AS vec_i", "cell AS a", "part AS pa", "to AS b", "to_part AS pb"
    )
    right = sent.where("struct(to, to_part) <= struct(cell, part)").selectExpr(
        "id AS id_j", "vec AS vec_j", "to AS a", "to_part AS pa", "cell AS b", "part AS pb"
    )
    pairs = left.join(right, ["a", "pa", "b", "pb"]).where("struct(a, pa) < struct(b, pb) OR id_i < id_j")
    return pairs.agg(F.max(sqdist("vec_i", "vec_j", dim)).alias("d2")).first()["d2"]


def _by_cell(values: dict[int, int], cell: str = "cell"):
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col(cell))


def avg_pairwise_distance(points: DataFrame) -> DataFrame:
    """Mean distance over pairs ``i < j`` of a small set (J3), one row
    ``avg_distance``: coresets and solutions, as all pairs are compared.

    NULL for fewer than two points (the reference divides 0 by 0).
    """
    pts = _points(points)
    n, dim = point_stats(pts)
    return self_pairs(pts, n).agg(F.avg(F.sqrt(sqdist("vec_i", "vec_j", dim))).alias("avg_distance"))


def _sampled(pts: DataFrame, n: int, k: int, seed: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sample, the other rows, and of the latter those next to the border (a
    written table of some ``8 * sqrt(k)`` rows; none if all rows are drawn).

    Ranks are uniform, so about ``k`` rows and a margin have a rank below
    ``(k + margin) / n`` of their range: one scan writes those, and the border is
    found in them. Should they be fewer than ``k`` (a chance far below 10^-9, or ids
    that repeat), the border is found by counting over all rows.
    """
    if k < 0:
        raise ValueError("k must not be negative")
    ranked = pts.withColumn("__h", seeded_rank(seed, "id"))
    if k == 0 or n == 0:
        return pts.where("false"), pts, pts.where("false")
    if k >= n:
        return pts, pts.where("false"), pts.where("false")
    top = min(RANK_RANGE, (k + 8 * math.isqrt(k) + 64) * RANK_RANGE // n)
    near = stored(ranked.where(F.col("__h") < top), "near") if top < RANK_RANGE else ranked
    found = near.count() if top < RANK_RANGE else n
    if found < k:
        near, found = ranked, n
    border, rest = _border(near, found, k)
    # rows with equal hashes (hardly ever more than one) go by id
    last = near.where(F.col("__h") == border).select("id").orderBy("id").limit(rest).agg(F.max("id")).first()[0]
    inside = (F.col("__h") < border) | ((F.col("__h") == border) & (F.col("id") <= F.lit(last)))
    return near.where(inside).drop("__h"), ranked.where(~inside).drop("__h"), near.where(~inside).drop("__h")


def _border(near: DataFrame, n: int, k: int) -> tuple[int, int]:
    """The k-th smallest rank and how many rows that have it are drawn."""
    if n > DRIVER_RANKS:
        return kth_smallest(near.select("__h"), "__h", k, bits=60)
    ranks = sorted(near.select("__h").toArrow().column(0).to_pylist())
    return ranks[k - 1], k - ranks.index(ranks[k - 1])


def sample_points(points: DataFrame, k: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """Exactly ``min(k, n)`` rows without replacement, repeatable.

    Rows are ranked by 60 bits of ``md5('<seed>:<id>')``, then by id. One count and
    one scan of the rows, which ranks each once, for any ``k`` (see ``_sampled``).
    """
    pts = _points(points)
    return _sampled(pts, pts.count(), k, seed)[0]


def sample_rest(points: DataFrame, k: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """The rows not drawn by :func:`sample_points` (J4 after R1)."""
    pts = _points(points)
    return _sampled(pts, pts.count(), k, seed)[1]


def remove_rows(points: DataFrame, removed: DataFrame, n_removed: int) -> DataFrame:
    """Rows of ``points`` whose id is not in ``removed`` (J4), by identity.

    The id list is broadcast when its counted size fits, else shuffled.
    """
    ids = removed.select("id")
    if fits_broadcast(points.sparkSession, n_removed, 16):
        ids = F.broadcast(ids)
    return points.join(ids, "id", "left_anti")


def sampled_diameter(points: DataFrame, k: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """Largest distance from a sample of ``k`` points to the other points (J2), one
    row ``diameter``.

    At least half the exact diameter when ``k < n``; NULL when nothing is left
    outside the sample.
    """
    best, _, _ = sampled_search(points, k, seed)
    return points.sparkSession.createDataFrame([(best,)], "diameter double")


def sampled_search(points: DataFrame, k: int, seed: int = DEFAULT_SEED) -> tuple[float | None, int, int]:
    """``(distance, rows, rows compared with the whole sample)``.

    Two scans: one draws the sample, one measures the other rows. A few points of
    the sample are pivots, each with the largest distance ``reach`` of a sample
    point from it. A row is at most ``distance to pivot + reach`` from any sample
    point, so if that does not pass the best distance known so far (of the rows
    next to the sample's border, which the first scan brought along), only its
    distances to the pivots count. The sample is broadcast in blocks under the
    cap, rows are not copied, and no pair is a row.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    pts = _points(points)
    n = pts.count()
    sample, rest, near = _sampled(pts, n, k, seed)
    stats = sample.agg(*point_checks()).first()
    check_point_stats(stats["n"], stats["dmin"], stats["dmax"], stats["bad"])
    if k >= n:
        return None, 0, 0
    dim = stats["dmin"]
    unrolled = dim if dim * SAMPLE_PIVOTS <= MAX_UNROLLED_DIM else None
    pivots, reach = _spread(sample, min(SAMPLE_PIVOTS, k), unrolled)
    # a row that can't be measured has no distance, and is reported below
    sound = f"size(vec) = {dim} AND NOT ({bad_vector_sql()})"
    to_pivot = [f"CASE WHEN {sound} THEN sqrt({sqdist_sql('vec', p, unrolled)}) END" for p in pivots]
    low = near.where(F.expr(sound)).agg(F.max(F.greatest(*map(F.expr, to_pivot), F.lit(0.0)))).first()[0] or 0.0
    bound = [f"d[{j}] + {r!r}D" for j, r in enumerate(reach)]
    can_win = f"least({', '.join(bound)}, double('Infinity')) * {1 + SLACK!r}D > {low!r}D"
    measured = rest.select("vec", F.expr(f"array({', '.join(to_pivot)})").alias("d")).select(
        "vec", "d", F.expr(f"d[0] IS NOT NULL AND {can_win}").alias("open")
    )

    size = min(k, n) * vector_row_bytes(dim, 0)
    blocks = max(1, math.ceil(size / broadcast_limit(pts.sparkSession)))
    anchors = sample.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")).agg(F.collect_list("vec").alias("anchors"))
    far = (
        "CASE WHEN open THEN sqrt(array_max(transform(anchors, c -> "
        "aggregate(zip_with(vec, c, (x, y) -> (x - y) * (x - y)), 0D, (s, t) -> s + t)))) ELSE array_max(d) END"
    )
    best, compared = None, 0
    for b in range(blocks):
        own = F.broadcast(anchors.where(F.col("block") == b).select(F.lit(0).alias("__k"), "anchors"))
        row = measured.withColumn("__k", F.lit(0)).join(own, "__k").agg(
            F.max(F.expr(far)).alias("best"), F.count_if("open").alias("open"), *point_checks()
        ).first()
        check_point_stats(row["n"], row["dmin"], row["dmax"], row["bad"])
        if row["n"] and row["dmin"] != dim:
            raise PointSetError("points have different dimensions")
        best = max(x for x in (best, row["best"]) if x is not None) if row["n"] else best
        compared += row["open"]
    return best, n - min(k, n), compared


def _spread(sample: DataFrame, pivots: int, unrolled: int | None) -> tuple[list, list]:
    """A few points of the sample, each far from those before, and the largest
    distance of a sample point from each."""
    centers = [[float(x) for x in sample.orderBy("id").first()["vec"]]]
    reach = []
    while True:
        d2 = [sqdist_sql("vec", c, unrolled) for c in centers]
        reach.append(math.sqrt(sample.agg(F.max(F.expr(d2[-1]))).first()[0]))
        if len(centers) == pivots:
            return centers, reach
        centers.append(_farthest(sample, f"least({', '.join(d2)})" if len(d2) > 1 else d2[0]))
