import math
import random

import pytest
from pyspark.sql import functions as F

from spreadkit.operators import geometry
from spreadkit.operators.pairs import PointSetError, point_stats, self_pairs
from spreadkit.operators.select import kth_smallest
from spreadkit.runtime import BROADCAST_CONF
from spreadkit.sources import tables

from conftest import FIXTURE_C, SF

D_C = 12.806248


def value(df):
    return df.first()[0]


@pytest.mark.parametrize("pivots", [1, 2, 6, 9])
def test_fixture_c_diameter(make_points, pivots):
    assert round(value(geometry.diameter(make_points(FIXTURE_C), pivots)), 6) == D_C


def test_fixture_c_average(make_points):
    assert round(value(geometry.avg_pairwise_distance(make_points(FIXTURE_C))), 6) == 7.151080


def test_distances_to_the_first_center(make_points):
    pts = make_points(FIXTURE_C).withColumn("g", F.col("id") % 2)
    rows = geometry.distances_to_center(pts, "g", squared=True).collect()
    assert sorted(map(tuple, rows)) == [(0, 2, 1.0), (0, 4, 64.0), (1, 3, 81.0), (1, 5, 65.0)]


def test_blocked_pairs_cover_all_pairs(spark):
    pts = tables.embedding_points(spark, SF)
    n, _ = point_stats(pts)
    for block_rows in (30, 100, 10_000):
        pairs = self_pairs(pts, n, block_rows=block_rows)
        agg = pairs.agg(F.count(F.lit(1)).alias("c"), F.min(F.col("id_j") - F.col("id_i")).alias("m")).first()
        assert agg.c == n * (n - 1) // 2 and agg.m > 0


def test_sampled_diameter_in_blocks(spark):
    pts = tables.embedding_points(spark, SF)
    whole = value(geometry.sampled_diameter(pts, 60))
    spark.conf.set(BROADCAST_CONF, "8000")  # five blocks
    try:
        assert value(geometry.sampled_diameter(pts, 60)) == whole
    finally:
        spark.conf.unset(BROADCAST_CONF)


def brute_diameter(points):
    pts = [list(r.vec) for r in points.collect()]
    return max(math.dist(p, q) for p in pts for q in pts)


@pytest.mark.parametrize("pivots", [1, 4])
@pytest.mark.parametrize("block_rows", [16, 16384])
def test_diameter_equals_all_pairs(spark, monkeypatch, pivots, block_rows):
    monkeypatch.setattr(geometry, "MAX_BLOCK_ROWS", block_rows)
    pts = tables.embedding_points(spark, SF).where("id < 120")
    assert math.isclose(value(geometry.diameter(pts, pivots)), brute_diameter(pts), rel_tol=1e-12)
    flat = tables.lineitem_points(spark, SF).limit(600)
    assert math.isclose(value(geometry.diameter(flat, pivots)), brute_diameter(flat), rel_tol=1e-12)


def test_kth_smallest_with_ties_and_negative_values(spark):
    values = [5, -3, 5, 0, -(2**62), 2**62, 5, 7, -3]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    ordered = sorted(values)
    for k in range(1, len(values) + 1):
        found, rest = kth_smallest(df, "v", k)
        assert found == ordered[k - 1] and rest == k - ordered.index(found)


def test_sampled_diameter_bounds(spark):
    pts = tables.embedding_points(spark, SF)
    exact = value(geometry.diameter(pts, 1))
    for k in (1, 5, 50):
        approx = value(geometry.sampled_diameter(pts, k))
        assert exact / 2 - 1e-9 <= approx <= exact + 1e-9


def test_sample_is_exact_size_and_repeatable(spark):
    pts = tables.embedding_points(spark, SF)
    s1 = [r.id for r in geometry.sample_points(pts, 7).collect()]
    s2 = [r.id for r in geometry.sample_points(pts.repartition(5), 7).collect()]
    assert len(s1) == 7 and sorted(s1) == sorted(s2)
    rest = geometry.sample_rest(pts, 7)
    assert rest.count() == pts.count() - 7
    assert rest.join(geometry.sample_points(pts, 7), "id").count() == 0


def test_empty_and_single_point(spark, make_points):
    empty = make_points([])
    assert value(geometry.diameter(empty)) is None
    assert value(geometry.diameter(empty, 1)) is None
    assert value(geometry.avg_pairwise_distance(empty)) is None
    one = make_points([(9, (1.0, 2.0))])
    assert value(geometry.diameter(one)) == 0.0
    assert value(geometry.diameter(one, 1)) == 0.0
    assert value(geometry.avg_pairwise_distance(one)) is None
    assert value(geometry.sampled_diameter(one, 1)) is None


def test_equal_points_have_zero_diameter(make_points):
    pts = make_points([(0, (1, 1)), (1, (1, 1)), (2, (1, 1))])
    assert value(geometry.diameter(pts)) == 0.0


def test_mixed_dimensions_raise(make_points):
    pts = make_points([(0, (1, 1)), (1, (1, 1, 1))])
    with pytest.raises(PointSetError):
        geometry.diameter(pts, 1)


def test_duplicate_vectors_are_kept_by_identity(make_points):
    pts = make_points([(0, (1, 1)), (1, (1, 1)), (2, (4, 5))])
    rest = geometry.remove_rows(pts, pts.filter("id = 0"), 1)
    assert sorted(r.id for r in rest.collect()) == [1, 2]
    assert math.isclose(value(geometry.diameter(pts)), 5.0)


@pytest.mark.parametrize("vec", [None, [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0]])
def test_unmeasurable_vectors_raise(spark, vec):
    from spreadkit.operators import centers

    df = spark.createDataFrame([(0, [0.0, 0.0]), (1, vec), (2, [3.0, 4.0])], "id bigint, vec array<double>")
    for run in (
        lambda: geometry.diameter(df).first(),
        lambda: geometry.sampled_diameter(df, 1).first(),
        lambda: geometry.avg_pairwise_distance(df).first(),
        lambda: centers.farthest_first(df, 2).collect(),
    ):
        with pytest.raises(PointSetError):
            run()


def test_sample_border_beyond_the_margin_is_found_by_counting(spark, monkeypatch):
    """A margin that is far too small: the same sample, from all rows."""
    pts = tables.embedding_points(spark, SF)
    want = sorted(r.id for r in geometry.sample_points(pts, 100).collect())
    monkeypatch.setattr(geometry, "RANK_RANGE", 1 << 40)
    assert sorted(r.id for r in geometry.sample_points(pts, 100).collect()) == want
    monkeypatch.undo()
    monkeypatch.setattr(geometry, "DRIVER_RANKS", 3)
    assert sorted(r.id for r in geometry.sample_points(pts, 100).collect()) == want


def test_sample_and_rest_share_the_rows_for_any_k(spark, make_points):
    pts = make_points([(i, (i, 0)) for i in range(40)])
    for k in (0, 1, 39, 40, 100):
        inside, outside = geometry.sample_points(pts, k), geometry.sample_rest(pts, k)
        assert inside.count() == min(k, 40) and outside.count() == 40 - min(k, 40)
        assert inside.join(outside, "id").count() == 0


@pytest.mark.parametrize("k", [1, 2, 7, 60])
def test_sampled_diameter_skips_rows_that_cannot_win(spark, k):
    """Equal to comparing all rows with the sample; on prices most rows need not be."""
    pts = tables.lineitem_points(spark, SF)
    sample = {r.id: list(r.vec) for r in geometry.sample_points(pts, k).collect()}
    rest = [list(r.vec) for r in pts.collect() if r.id not in sample]
    best, rows, compared = geometry.sampled_search(pts, k)
    assert math.isclose(best, max(math.dist(x, s) for x in rest for s in sample.values()), rel_tol=1e-12)
    assert rows == len(rest) and compared < (rows / 2 if k < 10 else rows)


def test_mixed_dimensions_outside_the_sample_raise(make_points):
    pts = make_points([(i, (1, 2)) for i in range(50)] + [(50, (1, 2, 3))])
    with pytest.raises(PointSetError):
        geometry.sampled_diameter(pts, 2)


def test_distances_to_center_without_broadcast(spark):
    pts = tables.embedding_points(spark, SF).withColumn("g", F.col("id") % 3)
    want = sorted(map(tuple, geometry.distances_to_center(pts, "g").collect()))
    spark.conf.set(BROADCAST_CONF, "0")
    try:
        assert sorted(map(tuple, geometry.distances_to_center(pts, "g").collect())) == want
    finally:
        spark.conf.unset(BROADCAST_CONF)


@pytest.mark.parametrize("pivots", [1, 4])
def test_diameter_of_random_points_makes_no_row_of_a_pair(make_points, monkeypatch, pivots):
    """Where no bound helps, the pairs of points are compared inside the tasks."""
    from spreadkit.operators import metric_tree

    monkeypatch.setattr(metric_tree, "FEW_PAIRS", 256)
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(32)]) for i in range(300)]
    want = max(math.dist(a, b) for _, a in rows for _, b in rows)
    got = geometry.diameter(make_points(rows), pivots=pivots, tree_rows=0, leaf_rows=16).first()[0]
    assert math.isclose(got, want, rel_tol=1e-12)
