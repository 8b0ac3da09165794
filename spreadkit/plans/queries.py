"""Named queries over the test tables: one per operator of the inventory.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables. Doubles are rounded to 6 decimals so that results can be compared
with an independent engine; the operators themselves never round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadkit.functions.keys import partition_number
from spreadkit.operators import centers, counts, diversity, geometry, words
from spreadkit.sources import tables
from spreadkit.sources.labelled import parse_labelled
from spreadkit.sources.points import parse_points
from spreadkit.sources.text import numbered_lines, read_lines
from spreadkit.functions.vectors import coordinates
from spreadkit.runtime import work_path

# Fixed parameters of the registered queries.
K = 8  # buckets / salts / partitions for the count programs
L = 4  # groups for the two-round diversity plan
PICKS = 6  # k: centers per group and size of the diverse set
MANY_PICKS = 20  # past the rounds between two checkpoints
MANY_GROUP_PICKS = 12
ODD_PICKS = 5
LARGE_SAMPLE = 1000
SMALL_LEAF = 64
SEED = geometry.DEFAULT_SEED

Builder = Callable[[SparkSession, str], DataFrame]


def _r(col: str, name: str | None = None):
    return F.round(F.col(col), 6).alias(name or col)


# -- sources -----------------------------------------------------------------

def read_labelled(spark, sf):
    return parse_labelled(tables.labelled_lines(spark, sf))


def read_labelled_permissive(spark, sf):
    """Every seventh line lacks its class: what is read, and what is left out."""
    lines = tables.labelled_lines_with_gaps(spark, sf)
    good = parse_labelled(lines, mode="permissive").agg(
        F.count(F.lit(1)).alias("n_read"), F.sum("key").cast("bigint").alias("key_sum")
    )
    bad = parse_labelled(lines, mode="rejected").agg(F.count(F.lit(1)).alias("n_rejected"))
    return good.withColumn("one", F.lit(1)).join(bad.withColumn("one", F.lit(1)), "one").drop("one")


def read_points(spark, sf):
    pts = parse_points(tables.lineitem_lines(spark, sf), id_col="id")
    return pts.select("id", *coordinates("vec", len(tables.LINEITEM_COORDINATES)))


def _written(lines, label):
    """A folder of text files that hold the rows of ``value`` in order."""
    path = work_path(lines.sparkSession, label)
    lines.write.text(path)
    return path


def read_points_file(spark, sf):
    """Points from text files that hold no ids: a line's number is its id."""
    columns = tables.LINEITEM_COORDINATES
    lines = tables.lineitem_lines(spark, sf, sort=True).select("value")
    pts = parse_points(numbered_lines(spark, _written(lines, "points")), id_col="line_id")
    return pts.select("id", *coordinates("vec", len(columns)))


def document_lines_file(spark, sf):
    """Every line of a text file, with its number."""
    lines = words.lines(tables.documents(spark, sf)).select(F.col("text").alias("value")).orderBy("value")
    numbered = numbered_lines(spark, _written(lines, "lines"))
    return numbered.select("line_id", F.md5("value").alias("digest"))


def word_count_file(spark, sf):
    lines = words.lines(tables.documents(spark, sf)).select(F.col("text").alias("value"))
    read = read_lines(spark, _written(lines, "words"), partitions=K)
    return words.word_count(read.select(F.col("value").alias("text")))


def class_count_file(spark, sf):
    lines = tables.labelled_lines(spark, sf)
    return counts.class_count(parse_labelled(read_lines(spark, _written(lines, "labelled"))))


# -- counts ------------------------------------------------------------------

def class_count(spark, sf):
    return counts.class_count(tables.labelled(spark, sf))


def class_count_two_round(spark, sf):
    return counts.class_count(tables.labelled(spark, sf), strategy="two_round", buckets=K)


def class_count_sorted(spark, sf):
    return counts.sorted_by_class(counts.class_count(tables.labelled(spark, sf)))


def most_frequent_class(spark, sf):
    return counts.most_frequent(counts.class_count(tables.labelled(spark, sf)))


def most_frequent_returnflag(spark, sf):
    return counts.most_frequent(counts.class_count(tables.returnflags(spark, sf)))


def max_partition_size(spark, sf):
    return counts.max_partition_size(tables.labelled(spark, sf), by=partition_number("key", K))


def max_partition_size_physical(spark, sf):
    return counts.balance(tables.labelled(spark, sf).repartition(K))


def exact_partition_sizes(spark, sf):
    return counts.partition_sizes(counts.exact_split(tables.labelled(spark, sf), K))


def document_count(spark, sf):
    return words.document_count(tables.documents(spark, sf))


def document_lines(spark, sf):
    return words.line_count(tables.documents(spark, sf))


# -- words -------------------------------------------------------------------

def tokenize(spark, sf):
    return words.token_counts(tables.documents(spark, sf))


def word_count(spark, sf):
    return words.word_count(tables.documents(spark, sf))


def word_count_lines(spark, sf):
    return words.word_count(words.lines(tables.documents(spark, sf)))


def word_count_salted(spark, sf):
    return words.word_count(tables.documents(spark, sf), strategy="salted", salts=K)


def word_count_partition(spark, sf):
    return words.word_count(tables.documents(spark, sf), strategy="partition")


def distinct_word_count(spark, sf):
    return words.distinct_word_count(words.word_count(tables.documents(spark, sf)))


def avg_word_length(spark, sf):
    return words.avg_word_length(words.word_count(tables.documents(spark, sf)))


# -- distances ---------------------------------------------------------------

def pairwise_sqdist(spark, sf):
    return geometry.distances_to_center(_grouped(spark, sf), "g", squared=True).select("i", "j", _r("sqdist"))


def pairwise_distance(spark, sf):
    return geometry.distances_to_center(_grouped(spark, sf), "g").select("i", "j", _r("distance"))


def _grouped(spark, sf):
    return tables.embedding_points(spark, sf).withColumn("g", partition_number("id", L))


def exact_diameter(spark, sf):
    return geometry.diameter(tables.embedding_points(spark, sf)).select(_r("diameter"))


def exact_diameter_blocked(spark, sf):
    """One pivot: the set is one cell, split by hash."""
    return geometry.diameter(tables.embedding_points(spark, sf), pivots=1).select(_r("diameter"))


def exact_diameter_tree(spark, sf):
    """The tree of balls for all points, however few."""
    pts = tables.embedding_points(spark, sf)
    return geometry.diameter(pts, tree_rows=0, leaf_rows=SMALL_LEAF).select(_r("diameter"))


def exact_diameter_pruned(spark, sf):
    return geometry.diameter(tables.lineitem_points(spark, sf)).select(_r("diameter"))


def avg_pairwise_distance(spark, sf):
    """Over the coreset: the average is a measure of small sets."""
    core = diversity.coreset(tables.embedding_points(spark, sf), PICKS, L)
    return geometry.avg_pairwise_distance(core).select(_r("avg_distance"))


def sample_k(spark, sf):
    return geometry.sample_points(tables.embedding_points(spark, sf), PICKS, SEED).select("id")


def sample_k_large(spark, sf):
    return geometry.sample_points(tables.lineitem_points(spark, sf), LARGE_SAMPLE, SEED).select("id")


def sample_rest(spark, sf):
    return geometry.sample_rest(tables.embedding_points(spark, sf), PICKS, SEED).select("id")


def sampled_diameter(spark, sf):
    return geometry.sampled_diameter(tables.embedding_points(spark, sf), PICKS, SEED).select(
        _r("diameter")
    )


# -- centers and diversity -----------------------------------------------------

def farthest_first(spark, sf):
    return centers.farthest_first(tables.embedding_points(spark, sf), PICKS).select("step", "id")


def farthest_first_k20(spark, sf):
    return centers.farthest_first(tables.embedding_points(spark, sf), MANY_PICKS).select("step", "id")


def center_diameter(spark, sf):
    return centers.center_diameter(tables.embedding_points(spark, sf), PICKS).select(
        _r("diameter")
    )


def coreset(spark, sf):
    return diversity.coreset(tables.embedding_points(spark, sf), PICKS, L).select(
        "g", "step", "id"
    )


def coreset_lineitem(spark, sf):
    return diversity.coreset(tables.lineitem_points(spark, sf), PICKS, L).select(
        "g", "step", "id"
    )


def coreset_lineitem_k12(spark, sf):
    return diversity.coreset(tables.lineitem_points(spark, sf), MANY_GROUP_PICKS, L).select(
        "g", "step", "id"
    )


def _core(spark, sf):
    return diversity.coreset(tables.embedding_points(spark, sf), PICKS, L)


def greedy_matching(spark, sf):
    return diversity.greedy_matching(_core(spark, sf), PICKS).select("pick", "id")


def greedy_matching_odd(spark, sf):
    return diversity.greedy_matching(_core(spark, sf), ODD_PICKS).select("pick", "id")


def greedy_matching_all(spark, sf):
    return diversity.greedy_matching(_core(spark, sf), PICKS * L).select("pick", "id")


def diversity_mapreduce(spark, sf):
    return diversity.diversify(tables.embedding_points(spark, sf), PICKS, L).select("pick", "id")


def diversity_mapreduce_lineitem(spark, sf):
    return diversity.diversify(tables.lineitem_points(spark, sf), PICKS, L).select("pick", "id")


def diversity_value(spark, sf):
    return diversity.diversity_value(tables.embedding_points(spark, sf), PICKS, L).select(
        _r("avg_distance")
    )


def diversity_value_lineitem(spark, sf):
    return diversity.diversity_value(tables.lineitem_points(spark, sf), PICKS, L).select(
        _r("avg_distance")
    )


QUERIES: dict[str, Builder] = {
    f.__name__: f
    for f in [
        read_labelled,
        read_labelled_permissive,
        read_points,
        read_points_file,
        document_lines_file,
        word_count_file,
        class_count_file,
        class_count,
        class_count_two_round,
        class_count_sorted,
        most_frequent_class,
        most_frequent_returnflag,
        max_partition_size,
        max_partition_size_physical,
        exact_partition_sizes,
        document_count,
        document_lines,
        tokenize,
        word_count,
        word_count_lines,
        word_count_salted,
        word_count_partition,
        distinct_word_count,
        avg_word_length,
        pairwise_sqdist,
        pairwise_distance,
        exact_diameter,
        exact_diameter_blocked,
        exact_diameter_tree,
        exact_diameter_pruned,
        avg_pairwise_distance,
        sample_k,
        sample_k_large,
        sample_rest,
        sampled_diameter,
        farthest_first,
        farthest_first_k20,
        center_diameter,
        coreset,
        coreset_lineitem,
        coreset_lineitem_k12,
        greedy_matching,
        greedy_matching_odd,
        greedy_matching_all,
        diversity_mapreduce,
        diversity_mapreduce_lineitem,
        diversity_value,
        diversity_value_lineitem,
    ]
}
