import os
import random

import pytest
from pyspark.sql import functions as F

from spreadkit.operators import centers, diversity
from spreadkit.runtime import BROADCAST_CONF, ensure_checkpoint_dir
from spreadkit.sources import tables

from conftest import FIXTURE_C, SF

ORDER = [0, 3, 4, 5, 1, 2]


def ids(df):
    return [r.id for r in df.orderBy("step").collect()]


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 6, 9])
def test_fixture_c_farthest_first(make_points, k):
    assert ids(centers.farthest_first(make_points(FIXTURE_C), k)) == ORDER[:k]


@pytest.mark.parametrize("k,expected", [(1, 0.0), (2, 10.0), (3, 12.806248), (6, 12.806248)])
def test_fixture_c_center_diameter(make_points, k, expected):
    assert round(centers.center_diameter(make_points(FIXTURE_C), k).first()[0], 6) == expected


def test_coreset_per_group(make_points):
    pts = make_points(FIXTURE_C)
    for k, want in ((2, {0: [0, 4], 1: [1, 3]}), (3, {0: [0, 4, 2], 1: [1, 3, 5]})):
        core = diversity.coreset(pts, k, 2).orderBy("g", "step").collect()
        got = {}
        for r in core:
            got.setdefault(r.g, []).append(r.id)
        assert got == want


def test_equal_points_give_distinct_ids(make_points):
    pts = make_points([(0, (1, 1)), (1, (1, 1)), (2, (1, 1))])
    rows = centers.farthest_first(pts, 2).orderBy("step").collect()
    assert [r.id for r in rows] == [0, 1] and rows[1].d2 == 0.0


def test_empty_group_and_small_group(spark, make_points):
    pts = make_points([(0, (0, 0)), (2, (5, 5)), (4, (1, 1)), (1, (3, 3))])
    core = diversity.coreset(pts, 5, 4).collect()
    by_group = {}
    for r in core:
        by_group.setdefault(r.g, set()).add(r.id)
    assert by_group == {0: {0, 4}, 1: {1}, 2: {2}}  # group 3 is empty
    assert centers.farthest_first(make_points([]), 3).count() == 0


def test_checkpoints_and_salted_centers_agree(spark):
    pts = tables.lineitem_points(spark, SF).withColumn("g", F.expr("cast(pmod(id, 4) as bigint)"))
    rows = lambda df: sorted(map(tuple, df.select("g", "step", "id").collect()))
    base = rows(centers.farthest_first(pts, 6, group="g"))
    assert rows(centers.farthest_first(pts, 6, group="g", checkpoint_every=2)) == base
    old = spark.conf.get(BROADCAST_CONF, None)
    spark.conf.set(BROADCAST_CONF, "64")  # nothing fits: centers are salted and shuffled
    try:
        assert rows(centers.farthest_first(pts, 6, group="g", checkpoint_every=3)) == base
    finally:
        spark.conf.unset(BROADCAST_CONF) if old is None else spark.conf.set(BROADCAST_CONF, old)


def test_no_table_of_distances_is_left(spark, make_points):
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    rng = random.Random(4)
    pts = make_points([(i, (rng.random(), rng.random())) for i in range(200)])
    assert centers.farthest_first(pts, 20, checkpoint_every=4).count() == 20
    assert not [x for x in os.listdir(folder) if x.startswith("distances-")]


def test_null_group_and_repeated_id_raise(spark):
    rows = [(None, 1, [0.0]), (None, 2, [1.0]), (0, 3, [2.0])]
    with pytest.raises(centers.GroupError):
        centers.farthest_first(spark.createDataFrame(rows, "g bigint, id bigint, vec array<double>"), 3, group="g")
    rows = [(0, 1, [0.0]), (0, 2, [1.0]), (0, 2, [2.0])]
    with pytest.raises(centers.GroupError):
        centers.farthest_first(spark.createDataFrame(rows, "g bigint, id bigint, vec array<double>"), 3, group="g")
    # one id in two groups is two points
    rows = [(0, 1, [0.0]), (1, 1, [1.0])]
    got = centers.farthest_first(spark.createDataFrame(rows, "g bigint, id bigint, vec array<double>"), 3, group="g")
    assert sorted((r.g, r.id) for r in got.collect()) == [(0, 1), (1, 1)]


def test_independent_of_input_order(spark):
    pts = tables.embedding_points(spark, SF)
    a = ids(centers.farthest_first(pts, 6))
    b = ids(centers.farthest_first(pts.orderBy("vec").repartition(7), 6))
    assert a == b


def test_k_must_be_positive(make_points):
    with pytest.raises(ValueError):
        centers.farthest_first(make_points(FIXTURE_C), 0)


@pytest.mark.parametrize("dim,joined", [(2, False), (9, True)])
def test_a_checkpoint_of_short_vectors_needs_no_join(spark, make_points, monkeypatch, dim, joined):
    joins = []
    join = type(spark.range(1)).join
    monkeypatch.setattr(type(spark.range(1)), "join", lambda self, other, on=None, how=None: joins.append(on) or join(self, other, on, how))
    rng = random.Random(5)
    pts = make_points([(i, [rng.random() for _ in range(dim)]) for i in range(60)])
    got = ids(centers.farthest_first(pts, 9, checkpoint_every=4))
    assert (["g", "id"] in joins) == joined
    assert got == ids(centers.farthest_first(pts, 9, checkpoint_every=100))
