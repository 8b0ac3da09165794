"""A tree of balls over a point set, searched for its farthest pair.

Build, level by level, all nodes of a level in the same few jobs:

* a node is a center (one of the points), the radius around it, and its points;
* a node with more than ``leaf_rows`` points is split by up to ``fanout`` pivots:
  the point farthest from its center, the center, and points drawn by hash; every
  point goes to its nearest pivot. The farthest pivot always takes itself away
  from the center, so a split makes progress whatever the data;
* a node of radius 0 is one place; its center stands for all of its points.

Search, pair of nodes by pair of nodes: two points of nodes ``a`` and ``b`` are at
most ``d(center a, center b) + radius a + radius b`` apart. Starting from the root
with itself, each level replaces pairs by pairs of children, raises the best
distance so far to the largest distance of two centers (they are points), and
drops pairs whose bound does not pass it. The search goes down, and the tree grows,
while the next level's pairs of nodes are few against the pairs of points they
stand for; of the
pairs then left (of leaves, or of nodes above them) the ones with the largest
bounds are compared first, then those that still can win; a point takes part in a
pair only if its own distance to its center allows it.

Comparing: nodes (in parts, if large) are dealt into blocks by hash, and a task
gets two blocks, the parts of them that occur in pairs, and these pairs. There are
more tasks than pairs of blocks, whatever the session's number of partitions, so
that few get several. A task compares part with part by a matrix product in single
precision, of which no more than a tile is held; rows of the tile that reach the
best, with room for its rounding, are multiplied again in double precision, and
the best pair of those is measured from its coordinates.

Points, nodes and pairs stay distributed; the driver holds the best distance,
counts and the first point. On data where distances concentrate no bound helps,
and all pairs of points are compared: the definition's own work, then some 3 * 10^8
pairs a second and core in 64 dimensions, with no pair ever a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spreadkit.functions.vectors import sqdist
from spreadkit.runtime import cached, fits_broadcast, stored, vector_row_bytes

LEAF_ROWS = 512
FANOUT = 16
MAX_LEVELS = 14
# pairs of nodes compared first, to raise the best distance
FIRST_PAIRS = 64
# A level is gone down to if it has at most so many pairs of nodes, or if these
# are at most so many (and so many a point) and stand for so many pairs of points each.
FEW_PAIRS = 1 << 16
MOST_PAIRS, MOST_PAIRS_A_POINT = 1 << 20, 4
POINT_PAIRS = 64
# Bytes of a part of a node and of a block, and blocks at least, so that their
# pairs are enough tasks. A block goes to as many tasks as there are blocks.
PART_BYTES = 1 << 20
BLOCK_BYTES = 24 << 20
MIN_BLOCKS = 8
# Tasks for each pair of blocks, as hashing deals several pairs to some and none to others.
TASKS_A_PAIR = 2
TILE = (256, 4096)
# relative slack of a bound, above the rounding of a distance
SLACK = 1e-9


def _small(df: DataFrame, rows: int, dim: int) -> DataFrame:
    """Broadcast at a quarter of the cap: several are on the driver at a time."""
    return F.broadcast(df) if fits_broadcast(df.sparkSession, 4 * rows, vector_row_bytes(dim, 6)) else df


class Tree:
    """A tree of ``points`` (``id, vec``; at least one row, ids unique), grown level by level."""

    def __init__(self, points: DataFrame, dim: int, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT):
        self.dim, self.leaf_rows, self.fanout = dim, leaf_rows, fanout
        self.nodes: list[DataFrame] = []  # by level: node, parent, center, radius, n, leaf
        self.sizes: list[int] = []  # nodes by level
        self._leaves: list[DataFrame] = []
        self._split = 0  # nodes of the last level that may be split
        root = [float(x) for x in points.select("vec", "id").orderBy("id").limit(1).first()["vec"]]
        self._live = cached(
            points.select("id", "vec", F.lit(1).cast("bigint").alias("node"), F.sqrt(sqdist("vec", root, dim)).alias("d"))
        )
        centers = points.sparkSession.createDataFrame([(1, 0, root)], "node bigint, parent bigint, center array<double>")
        self._level(centers, 1)

    @property
    def members(self) -> DataFrame:
        """``id, vec, leaf, r`` (distance to the leaf's center); of a place one row,
        id NULL. Nodes that are not split yet are leaves here."""
        parts = self._leaves
        if self._split:
            own = _small(self.nodes[-1].where("NOT leaf").select("node"), self._split, 0)
            parts = [*parts, self._live.join(own, "node", "left_semi").select("id", "vec", F.col("node").alias("leaf"), F.col("d").alias("r"))]
        return reduce(DataFrame.unionByName, parts)

    @property
    def n_nodes(self) -> int:
        return sum(self.sizes)

    def _level(self, centers: DataFrame, n_centers: int) -> None:
        """Adds the nodes of ``centers``, and the members of those that are leaves."""
        live = self._live
        stats = live.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("radius"))
        leaf = (F.col("n") <= self.leaf_rows) | (F.col("radius") == 0) | F.lit(len(self.nodes) == MAX_LEVELS)
        own = stored(
            stats.join(_small(centers, n_centers, self.dim), "node").select("node", "parent", "center", "radius", "n", leaf.alias("leaf")),
            "nodes",
        )
        self.nodes.append(own)
        sizes = own.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("leaf")).alias("split"), F.count_if("leaf").alias("leaves")).first()
        self.sizes.append(sizes["n"])
        self._split = sizes["split"]
        if sizes["leaves"]:
            # a place needs no members but its center
            places = own.where("leaf AND radius = 0").select(
                F.lit(None).cast(live.schema["id"].dataType).alias("id"), F.col("center").alias("vec"),
                F.col("node").alias("leaf"), F.lit(0.0).alias("r"),
            )
            done = _small(own.where("leaf AND radius > 0").select("node"), sizes["leaves"], 0)
            rows = live.join(done, "node", "left_semi").select("id", "vec", F.col("node").alias("leaf"), F.col("d").alias("r"))
            self._leaves.append(stored(rows.unionByName(places), "members"))

    def grow(self) -> bool:
        """Splits the nodes of the last level, unless all are leaves."""
        if not self._split:
            return False
        live, fanout, n_split, level = self._live, self.fanout, self._split, len(self.nodes) - 1
        split = self.nodes[-1].where("NOT leaf")
        tagged = live.join(_small(split.select("node", "n", "radius"), n_split, 0), "node")
        pivots = stored(_pivots(tagged, split, level, fanout), "pivots")
        by_node = pivots.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("idx", "center"))).alias("p"))
        distance = "sqrt(aggregate(zip_with(vec, c.center, (x, y) -> (x - y) * (x - y)), 0D, (s, t) -> s + t))"
        moved = live.join(_small(by_node, fanout * n_split, self.dim), "node").select(
            "id", "vec", "node", F.expr(f"transform(p, c -> {distance})").alias("ds"), "p"
        ).select("id", "vec", "node", "p", F.array_min("ds").alias("d"), F.array_position("ds", F.array_min("ds")).cast("int").alias("at"))
        centers = pivots.select((F.col("node") * fanout + F.col("idx")).alias("node"), F.col("node").alias("parent"), "center")
        self._live = cached(
            moved.select("id", "vec", (F.col("node") * fanout + F.element_at("p", F.col("at"))["idx"]).alias("node"), "d")
        )
        try:
            self._level(centers, fanout * n_split)
        finally:
            live.unpersist()
        return True

    def close(self) -> None:
        self._live.unpersist()


def build(points: DataFrame, dim: int, leaf_rows: int = LEAF_ROWS, fanout: int = FANOUT) -> Tree:
    """The whole tree of ``points``."""
    tree = Tree(points, dim, leaf_rows, fanout)
    try:
        while tree.grow():
            pass
    finally:
        tree.close()
    return tree


def _pivots(tagged: DataFrame, split: DataFrame, level: int, fanout: int) -> DataFrame:
    """``node, idx, center``: the farthest point (0), the center (1), and points
    drawn by hash. Several times as many are looked at as are taken, so few nodes
    get less than ``fanout``; none gets less than two."""
    far = tagged.where("d >= radius").groupBy("node").agg(F.min_by("vec", "id").alias("center")).withColumn("idx", F.lit(0))
    own = split.select("node", "center", F.lit(1).alias("idx"))
    u = F.pmod(F.xxhash64("id", F.lit(level)), F.lit(1 << 30))
    some = tagged.withColumn("u", u).where(F.col("u") * F.col("n") < F.lit(4 * fanout * (1 << 30)))
    rank = F.row_number().over(Window.partitionBy("node").orderBy("u", "id")) + 1
    drawn = some.withColumn("idx", rank).where(F.col("idx") < fanout).select("node", F.col("vec").alias("center"), "idx")
    return far.select("node", "center", "idx").unionByName(own).unionByName(drawn)


def longest(tree: Tree, low: float = 0.0) -> tuple[float, int]:
    """``(distance, compared)``: the largest distance of two points if it passes
    ``low``, else ``low``; and how many pairs of points were compared."""
    spark, dim = tree.members.sparkSession, tree.dim
    root = tree.nodes[0].first()
    alive = spark.createDataFrame(
        [(1, 1, 0.0, *(root[c] for c in ("radius", "radius", "n", "n", "leaf", "leaf")))] if root["radius"] else [],
        "node_i bigint, node_j bigint, apart double, radius_i double, radius_j double, n_i bigint, n_j bigint, leaf_i boolean, leaf_j boolean",
    )
    level, most = 0, max(MOST_PAIRS, MOST_PAIRS_A_POINT * root["n"])
    while True:
        # a leaf is its own child
        ahead = alive.agg(
            F.coalesce(F.sum(F.expr(f"if(leaf_i, 1D, {tree.fanout}D) * if(leaf_j, 1, {tree.fanout})")), F.lit(0.0)).alias("pairs"),
            F.coalesce(F.sum(F.expr("double(n_i) * n_j")), F.lit(0.0)).alias("work"),
            F.count_if(F.expr("NOT leaf_i OR NOT leaf_j")).alias("open"),
        ).first()
        if not ahead["open"] or ahead["pairs"] > FEW_PAIRS and (ahead["pairs"] > most or ahead["pairs"] * POINT_PAIRS > ahead["work"]):
            break
        level += 1
        if level == len(tree.nodes):
            tree.grow()
        if ahead["pairs"] > FEW_PAIRS:
            alive = alive.repartition(spark.sparkContext.defaultParallelism)
        pairs = stored(_children(tree, alive, level), "node-pairs")
        low = max(low, pairs.agg(F.max("apart")).first()[0] or 0.0)
        alive = pairs.where(_can_win("apart + radius_i + radius_j", low))
    bound = F.expr("apart + radius_i + radius_j").alias("bound")
    first = alive.select("*", bound).orderBy(F.desc("bound"), "node_i", "node_j").limit(FIRST_PAIRS)
    first = stored(first.drop("bound"), "first-pairs")
    low, compared = _compare(tree, first, level, low)
    # what was compared can't pass the best again, so the others alone are left
    rest = alive.where(_can_win("apart + radius_i + radius_j", low)).join(
        F.broadcast(first.select("node_i", "node_j")), ["node_i", "node_j"], "left_anti"
    )
    rest = stored(rest.select(alive.columns), "last-pairs")
    low, more = _compare(tree, rest, level, low)
    return low, compared + more


def _children(tree: Tree, alive: DataFrame, level: int) -> DataFrame:
    """Pairs of children of the pairs of nodes, on ``level``; a leaf is its own child."""
    columns = ["node", "center", "radius", "n", "leaf"]
    steps = tree.nodes[level].select(F.col("parent").alias("from"), *columns)
    for above in tree.nodes[:level]:
        steps = steps.unionByName(above.where("leaf").select(F.col("node").alias("from"), *columns))
    steps = _small(steps, sum(tree.sizes[: level + 1]), tree.dim)
    side = lambda s: steps.select(F.col("from").alias(f"from_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in columns])
    front = alive.select(F.col("node_i").alias("from_i"), F.col("node_j").alias("from_j"))
    return front.join(side("i"), "from_i").join(side("j"), "from_j").where(
        "from_i <> from_j OR node_i < node_j OR (node_i = node_j AND radius_i > 0)"
    ).select(
        "node_i", "node_j",
        F.when(F.col("node_i") == F.col("node_j"), 0.0).otherwise(F.sqrt(sqdist("center_i", "center_j", tree.dim))).alias("apart"),
        "radius_i", "radius_j", "n_i", "n_j", "leaf_i", "leaf_j",
    )


def _can_win(bound: str, low: float) -> str:
    return f"({bound}) * {1 + SLACK!r}D > {low!r}D"


def _at_level(tree: Tree, level: int) -> Column:
    """A leaf's ancestor on ``level`` (itself, if it is not below): a node's number
    is its parent's times the fanout, and a level's numbers start at a power of it."""
    at = F.col("leaf")
    node = at
    for m in range(level + 1, len(tree.nodes)):
        node = F.when(at >= tree.fanout**m, F.expr(f"leaf div {tree.fanout ** (m - level)}L")).otherwise(node)
    return node


def _compare(tree: Tree, pairs: DataFrame, level: int, low: float) -> tuple[float, int]:
    """The best distance after comparing the points of pairs of nodes."""
    ends = [pairs.select(F.col(f"node_{s}").alias("node"), F.col(f"n_{s}").alias("n")) for s in "ij"]
    used = stored(ends[0].unionByName(ends[1]).distinct(), "compared-nodes")
    size = used.agg(F.count(F.lit(1)).alias("nodes"), F.sum("n").alias("n")).first()
    if not size["nodes"]:
        return low, 0
    found = _compared(tree, pairs, used, size["nodes"], size["n"], level, low)
    row = found.agg(F.max("best").alias("best"), F.sum("compared").alias("n")).first()
    return max(low, row["best"] if row["best"] is not None else low), row["n"] or 0


def _compared(tree: Tree, pairs: DataFrame, used: DataFrame, n_used: int, n: int, level: int, low: float) -> DataFrame:
    """``best, compared`` of every pair of blocks; ``used``: the pairs' nodes, of ``n`` points."""
    dim = tree.dim
    part_rows = max(1, PART_BYTES // (8 * max(dim, 1)))
    blocks = max(MIN_BLOCKS, math.ceil(n * 8 * dim / BLOCK_BYTES))
    tasks = TASKS_A_PAIR * blocks * (blocks + 1) // 2
    parts = lambda n: F.ceil(F.col(n) / F.lit(part_rows)).cast("int")
    block = lambda node, part: F.pmod(F.xxhash64(node, part), F.lit(blocks)).cast("int")

    # a part is one row; a place has one point
    points = tree.members.withColumn("node", _at_level(tree, level)).join(_small(used, n_used, 0), "node")
    rows = points.select("node", F.pmod(F.xxhash64("id", "vec"), parts("n")).cast("int").alias("part"), "vec").groupBy(
        "node", "part"
    ).agg(F.flatten(F.collect_list("vec")).alias("points"))
    centers = reduce(DataFrame.unionByName, [t.select("node", "center") for t in tree.nodes[: level + 1]])
    rows = rows.join(_small(centers, sum(tree.sizes[: level + 1]), dim), "node")

    dealt = pairs.withColumn("part_i", F.explode(F.sequence(F.lit(0), parts("n_i") - 1))).withColumn(
        "part_j", F.explode(F.sequence(F.lit(0), parts("n_j") - 1))
    ).where("node_i <> node_j OR part_i <= part_j")
    dealt = dealt.withColumn("block_i", block("node_i", "part_i")).withColumn("block_j", block("node_j", "part_j"))
    dealt = dealt.select("*", F.least("block_i", "block_j").alias("a"), F.greatest("block_i", "block_j").alias("b"))
    sent = reduce(DataFrame.unionByName, [
        dealt.select(F.col("a").alias("to_a"), F.col("b").alias("to_b"), F.col(f"node_{s}").alias("node"), F.col(f"part_{s}").alias("part"))
        for s in "ij"
    ]).distinct()
    sent = sent.join(rows, ["node", "part"]).withColumn("block", block("node", "part"))
    dealt = dealt.select("a", "b", "node_i", "part_i", "node_j", "part_j", "apart", "radius_i", "radius_j")
    return sent.repartition(tasks, "to_a", "to_b").groupBy("to_a", "to_b").cogroup(
        dealt.repartition(tasks, "a", "b").groupBy("a", "b")
    ).applyInArrow(_farthest_of_blocks(dim, low), "best double, compared bigint")


def _farthest_of_blocks(dim: int, low: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Compares the points of two blocks' parts, for the given pairs of parts."""

    def run(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        rows = rows.sort_by([("block", "ascending"), ("node", "ascending"), ("part", "ascending")])
        column = lambda t, c: t.column(c).combine_chunks().to_numpy(zero_copy_only=False)
        values = lambda c: rows.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        at = {key: u for u, key in enumerate(zip(rows.column("node").to_pylist(), rows.column("part").to_pylist()))}
        sizes = np.array([n // dim for n in rows.column("points").combine_chunks().value_lengths().to_pylist()])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        x, centers = values("points"), values("center")
        r = np.sqrt(((x - np.repeat(centers, sizes, axis=0)) ** 2).sum(axis=1))

        # pairs of parts that both have points (a place fills one part), earlier part first
        keys = [[at.get(key, -1) for key in zip(pairs.column(f"node_{s}").to_pylist(), pairs.column(f"part_{s}").to_pylist())] for s in "ij"]
        i, j = np.array(keys[0], dtype=np.int64), np.array(keys[1], dtype=np.int64)
        apart, ri, rj = (column(pairs, c) for c in ("apart", "radius_i", "radius_j"))
        swap = i > j
        i, j, ri, rj = np.where(swap, j, i), np.where(swap, i, j), np.where(swap, rj, ri), np.where(swap, ri, rj)
        order = np.lexsort((j, i))
        order = order[i[order] >= 0]
        i, j, apart, ri, rj = i[order], j[order], apart[order], ri[order], rj[order]

        # |x - y|^2 = |x|^2 + (-2 x, 1) . (y, |y|^2), around the mean and to scale, so that nothing is lost or overflows
        z = x - x.mean(axis=0)
        scale = np.abs(z).max() or 1.0
        z /= scale
        sq = (z * z).sum(axis=1)
        left = np.hstack([-2 * z, np.ones((len(z), 1))]).astype(np.float32)
        right = np.hstack([z, sq[:, None]]).astype(np.float32)
        # above the rounding of a square in single precision, 3 (dim + 8) / 2^24 of the largest |x|^2
        room = (dim + 8) * 2.0**-22 * sq.max()
        best, compared = low, 0
        first, ends = np.unique(i, return_index=True)
        for u, s, e in zip(first, ends, [*ends[1:], len(i)]):
            own = np.arange(starts[u], starts[u + 1])
            own = own[(r[own] + (apart[s:e] + rj[s:e]).max()) * (1 + SLACK) > best]
            theirs = np.concatenate([np.arange(starts[v], starts[v + 1]) for v in j[s:e]])
            theirs = theirs[(r[theirs] + np.repeat(apart[s:e] + ri[s:e], sizes[j[s:e]])) * (1 + SLACK) > best]
            if not len(own) or not len(theirs):
                continue
            same = int(((theirs >= starts[u]) & (theirs < starts[u + 1])).sum())
            compared += len(own) * (len(theirs) - same) + same * (same - 1) // 2
            for c in range(0, len(theirs), TILE[1]):
                cols = theirs[c : c + TILE[1]]
                whole = cols[-1] - cols[0] + 1 == len(cols)
                other = (right[cols[0] : cols[-1] + 1] if whole else right[cols]).T
                for k in range(0, len(own), TILE[0]):
                    some = own[k : k + TILE[0]]
                    some = some[(left[some] @ other).max(axis=1) + sq[some] > (best / scale) ** 2 - room]
                    if not len(some):
                        continue
                    tile = sq[cols] - 2 * (z[some] @ z[cols].T)
                    most = tile.max(axis=1) + sq[some]
                    top = int(most.argmax())
                    if most[top] > (best / scale) ** 2:
                        pair = x[some[top]] - x[cols[tile[top].argmax()]]
                        best = max(best, float(np.sqrt((pair * pair).sum())))
        return pa.table({"best": pa.array([best], pa.float64()), "compared": pa.array([compared], pa.int64())})

    return run


def farthest_pair(points: DataFrame, dim: int, low: float = 0.0, leaf_rows: int = LEAF_ROWS) -> tuple[float, int]:
    """Largest distance of two points (at least ``low``), and the pairs compared."""
    tree = Tree(points, dim, leaf_rows)
    try:
        return longest(tree, low)
    finally:
        tree.close()
