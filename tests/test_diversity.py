import pytest

from spreadkit.operators import diversity
from spreadkit.sources import tables

from conftest import FIXTURE_C, SF

MATCHING = {
    1: ([0], None),
    2: ([3, 4], 12.806248),
    3: ([3, 4, 0], 10.268749),
    4: ([3, 4, 0, 5], 8.779600),
    5: ([3, 4, 0, 5, 1], 7.880212),
    6: ([0, 1, 2, 3, 4, 5], 7.151080),
}


def picks(df):
    return [r.id for r in df.orderBy("pick").collect()]


@pytest.mark.parametrize("k", sorted(MATCHING))
def test_fixture_c_greedy_matching(spark, make_points, k):
    from spreadkit.operators.geometry import avg_pairwise_distance

    want_ids, want_avg = MATCHING[k]
    got = diversity.greedy_matching(make_points(FIXTURE_C), k)
    assert picks(got) == want_ids
    avg = avg_pairwise_distance(got.select("id", "vec")).first()[0]
    assert (avg is None and want_avg is None) or round(avg, 6) == want_avg


@pytest.mark.parametrize("k,solution,avg", [(2, [4, 3], 12.806248), (3, [4, 3, 0], 10.268749)])
def test_fixture_c_two_rounds(make_points, k, solution, avg):
    pts = make_points(FIXTURE_C)
    assert picks(diversity.diversify(pts, k, 2)) == solution
    assert round(diversity.diversity_value(pts, k, 2).first()[0], 6) == avg


def test_zero_distances_pick_distinct_points(make_points):
    pts = make_points([(0, (1, 1)), (1, (1, 1)), (2, (1, 1)), (3, (1, 1))])
    assert picks(diversity.greedy_matching(pts, 3)) == [0, 1, 2]


def test_matching_independent_of_input_layout(spark):
    pts = tables.embedding_points(spark, SF)
    a = picks(diversity.greedy_matching(pts, 6))
    b = picks(diversity.greedy_matching(pts.repartition(5).orderBy("vec"), 6))
    assert a == b and len(set(a)) == 6


def test_one_group_two_rounds_equals_matching_on_centers(spark):
    from pyspark.sql import functions as F

    from spreadkit.operators.centers import farthest_first

    pts = tables.embedding_points(spark, SF)
    cent = farthest_first(pts, 6).withColumn("pos", F.col("step"))
    want = picks(diversity.greedy_matching(cent.select("id", "vec", "pos"), 6, order="pos"))
    assert picks(diversity.diversify(pts, 6, 1)) == want


def sequential(points, k):
    """The definition: take the best pair among unused points, again and again."""
    pts = sorted((r.id, list(r.vec)) for r in points.collect())
    edges = sorted(
        (-sum((x - y) ** 2 for x, y in zip(p[1], q[1])), p[0], q[0]) for i, p in enumerate(pts) for q in pts[i + 1 :]
    )
    out = []
    for _, i, j in edges:
        if len(out) < k - 1 and i not in out and j not in out:
            out += [i, j]
    return out + ([next(p for p, _ in pts if p not in out)] if k % 2 else [])


@pytest.mark.parametrize("k", [2, 3, 12, 25, 59])
def test_rounds_equal_sequential(spark, k):
    pts = tables.embedding_points(spark, SF).where("id < 60")
    got = picks(diversity.greedy_matching(pts, k))
    assert got == sequential(pts, k) and len(set(got)) == k


def test_rounds_with_ties(make_points):
    pts = make_points([(i, (i % 3, i // 3)) for i in range(12)])  # many equal distances
    for k in (2, 5, 11):
        assert picks(diversity.greedy_matching(pts, k)) == sequential(pts, k)


def test_all_points_come_in_order(spark):
    pts = tables.embedding_points(spark, SF).repartition(7)
    want = sorted(r.id for r in pts.collect())
    assert picks(diversity.greedy_matching(pts, len(want))) == want
    assert picks(diversity.greedy_matching(pts, len(want) + 5)) == want


def test_k_must_be_positive(make_points):
    from spreadkit.operators import geometry

    pts = make_points(FIXTURE_C)
    for bad in (lambda: diversity.greedy_matching(pts, 0), lambda: geometry.sampled_diameter(pts, 0),
                lambda: diversity.coreset(pts, 2, 0)):
        with pytest.raises(ValueError):
            bad()
