"""Farthest-first traversal, whole set or per group.

Semantics, fixed so that the answer does not depend on partitioning:

* the first center of a group is its smallest id;
* each later center is the not-yet-chosen point whose squared distance to
  the nearest chosen center is largest, ties going to the smaller id;
* a group smaller than ``k`` yields all its points; an empty group nothing;
* a NULL group or id, or an id that occurs twice in a group, is an error.

Every point carries its squared distance to the nearest center so far. A round
joins the one new center of each group (broadcast when the counted size fits,
else copied over salts and shuffled), lowers the distances, takes the largest
per group in a hash aggregate, and the smallest id among the points that have
it. As long as all centers fit the broadcast cap, a round's few rows go through
the driver, as a broadcast does, and from there into the next plan without a job
of their own; beyond it they are written to the shared folder, and nothing but
counts and the point checks reaches the driver.

The state of a round replaces that of the round before in executor memory. Every
``checkpoint_every`` rounds ``(g, id, d2)`` is written to the shared folder, the
previous such table removed, and the state rebuilt from it and the points, which
bounds what a lost executor makes others compute again. Short vectors
are written too, as to join them again costs more than their room.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadkit.functions.vectors import sqdist
from spreadkit.operators.pairs import check_point_stats, point_checks, with_group_row
from spreadkit.runtime import cached, fits_broadcast, here, remove_path, vector_row_bytes, work_path

CHOSEN = -1.0  # the distance of a point that is a center
SHORT_DIM = 8  # vectors up to here are written with the distances


class GroupError(ValueError):
    """Groups or ids that do not identify the points."""


def farthest_first(
    points: DataFrame, k: int, group: str | None = None, checkpoint_every: int = 8
) -> DataFrame:
    """Pick up to ``k`` centers per group by farthest-first traversal.

    ``points`` has ``id, vec array<double>`` and, if ``group`` is given, that
    group column. Returns ``[group,] step, id, vec, d2`` where ``step`` is
    0-based and ``d2`` is the squared distance to the nearest earlier center
    when the point was chosen (NULL for step 0).
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    if checkpoint_every < 1:
        raise ValueError("checkpoint_every must be at least 1")
    spark = points.sparkSession
    g = F.col(group) if group else F.lit(0)
    # by (g, id): the uniqueness check and the checkpoints' join need no other shuffle
    pts = cached(points.select(g.cast("bigint").alias("g"), "id", "vec").repartition("g", "id"))
    folder = work_path(spark, "centers")
    state, saved = pts, None
    try:
        groups, largest_group, dim = _checked(pts)
        small = fits_broadcast(spark, groups, vector_row_bytes(dim, 3))
        local = fits_broadcast(spark, groups * min(k, max(largest_group, 1)), vector_row_bytes(dim, 4))
        schema = pts.select("g", "id", "vec", F.lit(None).cast("double").alias("d2")).schema
        steps: list[DataFrame] = []

        def keep(rows: DataFrame) -> None:
            """The centers of the next step."""
            if local:
                steps.append(here(rows.select("g", "id", "vec", "d2")))
            else:
                path = f"{folder}/step={len(steps)}"
                rows.write.parquet(path)
                steps.append(spark.read.schema(schema).parquet(path))

        first = pts.groupBy("g").agg(F.min("id").alias("first"))
        chosen = with_group_row(pts, first, small).where("id = first")
        keep(chosen.select("g", "id", "vec", F.lit(None).cast("double").alias("d2")))
        state = pts.withColumn("d2", F.lit(float("inf")))
        for step in range(1, min(k, largest_group)):  # then every group has run out of points
            new = steps[-1].select("g", F.col("id").alias("center"), F.col("vec").alias("cvec"))
            lowered = with_group_row(state, new, small).select(
                "g", "id", "vec",
                F.when(F.col("id") == F.col("center"), F.lit(CHOSEN))
                .otherwise(F.least("d2", sqdist("vec", "cvec", dim))).alias("d2"),
            )
            before, state = state, cached(lowered)
            largest = state.groupBy("g").agg(F.max("d2").alias("largest")).where("largest >= 0")
            largest = here(largest) if local else largest
            best = with_group_row(state, largest, small).where("d2 = largest").groupBy("g").agg(
                F.min("id").alias("id"), F.min_by("vec", "id").alias("vec"), F.max("d2").alias("d2")
            )
            keep(best)
            if before is not pts:
                before.unpersist()
            if step % checkpoint_every == 0:
                path = work_path(spark, "distances")
                columns = ["g", "id", "vec", "d2"] if dim <= SHORT_DIM else ["g", "id", "d2"]
                state.select(columns).write.parquet(path)
                state.unpersist()
                read = spark.read.schema(state.select(columns).schema).parquet(path)
                state = read if dim <= SHORT_DIM else pts.join(read, ["g", "id"]).select("g", "id", "vec", "d2")
                if saved:
                    remove_path(spark, saved)
                saved = path
    finally:
        state.unpersist()
        pts.unpersist()
        if saved:
            remove_path(spark, saved)
    if local:
        numbered = [df.withColumn("step", F.lit(step)) for step, df in enumerate(steps)]
        result = here(reduce(DataFrame.unionByName, numbered))
    else:
        result = spark.read.schema(schema.add("step", T.IntegerType())).parquet(folder)
    return result.select(*([F.col("g").alias(group)] if group else []), "step", "id", "vec", "d2")


def _checked(pts: DataFrame) -> tuple[int, int, int]:
    """``(groups, points of the largest group, dim)``; raises for points that
    can't be measured or told apart."""
    per_id = pts.groupBy("g", "id").agg(*point_checks())  # no shuffle: pts is dealt by (g, id)
    per_group = per_id.groupBy("g").agg(
        F.sum("n").alias("n"), F.max("n").alias("most"), F.count_if(F.col("g").isNull() | F.col("id").isNull()).alias("nulls"),
        F.min("dmin").alias("dmin"), F.max("dmax").alias("dmax"), F.sum("bad").alias("bad"),
    )
    row = per_group.agg(
        F.count(F.lit(1)).alias("groups"), F.max("n").alias("n"), F.max("most").alias("most"), F.sum("nulls").alias("nulls"),
        F.min("dmin").alias("dmin"), F.max("dmax").alias("dmax"), F.sum("bad").alias("bad"),
    ).first()
    check_point_stats(row["n"] or 0, row["dmin"], row["dmax"], row["bad"] or 0)
    if row["nulls"]:
        raise GroupError("points have a NULL group or id")
    if (row["most"] or 0) > 1:
        raise GroupError("an id occurs more than once in a group")
    return row["groups"], row["n"] or 0, row["dmin"] or 0


def center_diameter(points: DataFrame, k: int) -> DataFrame:
    """Exact diameter of the ``k`` farthest-first centers (F2), one row ``diameter``."""
    from spreadkit.operators.geometry import diameter

    return diameter(farthest_first(points, k).select("id", "vec"))
