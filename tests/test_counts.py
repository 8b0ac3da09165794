import pytest


from spreadkit.functions.keys import bucket, partition_number
from spreadkit.operators import counts
from spreadkit.sources import tables

from conftest import SF


def pairs(spark, rows):
    return spark.createDataFrame(rows, "key bigint, class string")


FIXTURE_A = [(0, "cat"), (1, "dog"), (2, "cat"), (3, "bird"), (4, "cat"), (5, "dog")]


def test_class_count_sorted(spark):
    df = counts.sorted_by_class(counts.class_count(pairs(spark, FIXTURE_A)))
    assert [tuple(r) for r in df.collect()] == [("bird", 1), ("cat", 3), ("dog", 2)]


def test_two_round_matches_direct_for_any_k(spark):
    src = tables.labelled(spark, SF)
    direct = sorted(map(tuple, counts.class_count(src).collect()))
    for k in (1, 2, 3, 8, 17):
        two = counts.class_count(src, strategy="two_round", buckets=k)
        assert sorted(map(tuple, two.collect())) == direct


def test_most_frequent_and_ties(spark):
    top = counts.most_frequent(counts.class_count(pairs(spark, FIXTURE_A))).collect()
    assert [tuple(r) for r in top] == [("cat", 3)]
    tie = pairs(spark, [(0, "b"), (1, "a"), (2, "b"), (3, "a")])
    assert [tuple(r) for r in counts.most_frequent(counts.class_count(tie)).collect()] == [("a", 2)]


def test_reserved_looking_class_is_ordinary(spark):
    df = pairs(spark, [(0, "maxPartitionSize"), (1, "maxPartitionSize"), (2, "x")])
    got = dict(map(tuple, counts.class_count(df).collect()))
    assert got == {"maxPartitionSize": 2, "x": 1}


def test_bucket_sign_follows_dividend(spark):
    row = pairs(spark, [(-7, "x")]).select(bucket("key", 3).alias("b")).first()
    assert row.b == -1


def test_max_partition_size_logical(spark):
    df = counts.max_partition_size(pairs(spark, FIXTURE_A), by=partition_number("key", 2))
    assert df.first()["max_partition_size"] == 3


def test_max_partition_size_of_negative_keys(spark):
    df = pairs(spark, [(-9, "x"), (-1, "x"), (7, "x"), (15, "x")])
    assert counts.max_partition_size(df, by=partition_number("key", 8)).first()["max_partition_size"] == 4


def test_balance_of_a_redistribution(spark):
    row = counts.balance(tables.labelled(spark, SF).repartition(8)).first()
    assert (row.partitions, row.n_rows, row.balanced) == (8, 1000, True)


def test_partition_sizes_physical_cover_all_rows(spark):
    src = tables.labelled(spark, SF).repartition(8)
    sizes = counts.partition_sizes(src).collect()
    assert sum(r["size"] for r in sizes) == src.count()
    assert len(sizes) == 8


def test_empty_input_gives_no_class(spark):
    empty = pairs(spark, [])
    assert counts.class_count(empty).count() == 0
    assert counts.most_frequent(counts.class_count(empty)).count() == 0
    assert counts.max_partition_size(empty).first()[0] is None


@pytest.mark.parametrize("n,k", [(0, 3), (1, 4), (10, 3), (1000, 7), (64, 8)])
def test_exact_split_differs_by_one_at_most(spark, n, k):
    from spreadkit.operators.counts import exact_split, partition_sizes

    df = spark.range(n, numPartitions=5).selectExpr("id", "'same' AS class")
    split = exact_split(df, k)
    sizes = sorted(r["size"] for r in partition_sizes(split).collect())
    assert sum(sizes) == n and sorted(r.id for r in split.collect()) == list(range(n))
    assert len(sizes) == min(n, k) and (not sizes or sizes[-1] - sizes[0] <= 1)
