import pytest
from pyspark.errors import PySparkException

from spreadkit.sources import numbered_lines, parse_labelled, parse_points, read_lines


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_labelled_fixture_a(spark):
    df = parse_labelled(lines(spark, ["0 cat", "1 dog", "2 cat", "3 bird", "4 cat", "5 dog"]))
    assert df.columns == ["key", "class"]
    assert sorted(map(tuple, df.collect())) == [
        (0, "cat"), (1, "dog"), (2, "cat"), (3, "bird"), (4, "cat"), (5, "dog")
    ]


def test_labelled_extra_tokens_and_empty_class(spark):
    rows = parse_labelled(lines(spark, ["5  x", "6 a b c", "-7 x", "+8 y"])).collect()
    assert sorted(map(tuple, rows)) == [(-7, "x"), (5, ""), (6, "a"), (8, "y")]


@pytest.mark.parametrize("bad", ["x cat", "5", "5 ", "", " 5 x", "1.5 x"])
def test_labelled_strict_errors(spark, bad):
    with pytest.raises(PySparkException):
        parse_labelled(lines(spark, ["1 ok", bad])).collect()


def test_labelled_strict_check_survives_pruning(spark):
    # Only the class is used downstream; the malformed key must still fail.
    with pytest.raises(PySparkException):
        parse_labelled(lines(spark, ["x cat"])).select("class").collect()


def test_labelled_permissive_drops(spark):
    df = parse_labelled(lines(spark, ["1 a", "x cat", "5", ""]), mode="permissive")
    assert [tuple(r) for r in df.collect()] == [(1, "a")]


def test_points_parse(spark):
    df = spark.createDataFrame([(0, "1,2,"), (1, " 3.5 ,-4"), (2, "1e3,0")], "id bigint, value string")
    rows = sorted(parse_points(df, id_col="id").collect())
    assert [(r.id, r.vec) for r in rows] == [(0, [1.0, 2.0]), (1, [3.5, -4.0]), (2, [1000.0, 0.0])]


@pytest.mark.parametrize("bad", ["", "a,b", "NaN,1", "Infinity,1", "1,,2"])
def test_points_strict_errors(spark, bad):
    df = spark.createDataFrame([(0, "1,2"), (1, bad)], "id bigint, value string")
    with pytest.raises(PySparkException):
        parse_points(df, id_col="id").collect()


def test_points_permissive(spark):
    df = spark.createDataFrame([(0, "1,2"), (1, ""), (2, "a,b"), (3, "NaN,1")], "id bigint, value string")
    assert [r.id for r in parse_points(df, id_col="id", mode="permissive").collect()] == [0]


def test_rejected_lines_are_kept(spark):
    df = lines(spark, ["1 a", "x cat", "5", "", None])
    assert sorted(str(r.value) for r in parse_labelled(df, mode="rejected").collect()) == ["", "5", "None", "x cat"]
    pts = spark.createDataFrame([(0, "1,2"), (1, ""), (2, None)], "id bigint, value string")
    assert [r.id for r in parse_points(pts, id_col="id", mode="rejected").orderBy("id").collect()] == [1, 2]


def test_lineitem_id_has_room_at_scale_factor_1000(spark):
    """Neighbouring and extreme keys give distinct ids that do not overflow."""
    from itertools import product

    from spreadkit.sources.tables import lineitem_id

    edge = lambda top: [1, 2, top - 1, top]
    rows = list(product(edge(6 * 10**9), edge(2 * 10**8), edge(10**7), [1, 7], [1.0, 50.0]))
    df = spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double")
    got = [r.id for r in df.select(lineitem_id().alias("id")).collect()]
    assert None not in got and len(set(got)) == len(rows)


def test_text_file_source_end_to_end(spark, tmp_path):
    from spreadkit.operators import counts

    path = tmp_path / "pairs.txt"
    path.write_text("0 cat\n1 dog\n2 cat\n3 bird\n4 cat\n5 dog\n")
    lines = read_lines(spark, str(path), partitions=2)
    assert lines.rdd.getNumPartitions() == 2
    parsed = parse_labelled(lines)
    got = counts.sorted_by_class(counts.class_count(parsed, strategy="two_round", buckets=2))
    assert [tuple(r) for r in got.collect()] == [("bird", 1), ("cat", 3), ("dog", 2)]
    sizes = counts.partition_sizes(lines).collect()
    assert sorted(r["size"] for r in sizes) == [3, 3]


def test_point_file_source(spark, tmp_path):
    path = tmp_path / "points.csv"
    path.write_text("0,0\n1,0,\n0,1\n10,0\n0,8\n9,1\n")
    numbered = read_lines(spark, str(path)).selectExpr("value", "row_number() over (order by value) as id")
    pts = parse_points(numbered, id_col="id")
    assert pts.count() == 6
    assert sorted(len(r.vec) for r in pts.collect()) == [2] * 6


@pytest.mark.parametrize("broadcast", ["", "0"])
def test_numbered_lines_follow_files_and_places(spark, tmp_path, broadcast):
    """Several files, each of several splits, blank lines and all line ends."""
    from spreadkit.runtime import BROADCAST_CONF

    want = []
    for f in range(4):
        own = [f"file {f} line {i} " + "x" * (i % 37) for i in range(400)] + ["", "é", ""]
        end = ["\n", "\r\n", "\n", "\r"][f]
        (tmp_path / f"part-{f}.txt").write_text(end.join(own) + end, newline="", encoding="utf-8")
        want += own
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    if broadcast:
        spark.conf.set(BROADCAST_CONF, broadcast)
    try:
        df = numbered_lines(spark, str(tmp_path))
        got = sorted(map(tuple, df.collect()))
        assert df.rdd.getNumPartitions() > 1 and read_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset(BROADCAST_CONF)
    assert got == list(enumerate(want))


def test_numbered_lines_of_nothing(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    assert numbered_lines(spark, str(tmp_path)).collect() == []


def test_points_of_a_file_without_ids(spark, tmp_path):
    (tmp_path / "points.csv").write_text("1,2\n3,4.5,\n-1,1e3\n")
    rows = parse_points(numbered_lines(spark, str(tmp_path)), id_col="line_id").collect()
    assert sorted(map(tuple, rows)) == [(0, [1.0, 2.0]), (1, [3.0, 4.5]), (2, [-1.0, 1000.0])]
