"""Plan-shape checks: exchanges, pruning, no Python in the hot path."""

from pyspark.sql import functions as F

from spreadkit.operators import counts, words
from spreadkit.plans import queries
from spreadkit.sources import tables

from conftest import SF


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_class_count_one_exchange_and_pruned_scan(spark):
    p = plan(counts.class_count(tables.labelled(spark, SF)))
    assert p.count("Exchange ") == 1
    assert "partial_count" in p
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in p or (
        "ReadSchema: struct<event_type:string>" in p
    )


def test_two_round_and_salted_have_two_exchanges(spark):
    p = plan(counts.class_count(tables.labelled(spark, SF), strategy="two_round"))
    assert p.count("Exchange ") == 2
    p = plan(words.word_count(tables.documents(spark, SF), strategy="salted"))
    assert p.count("Exchange ") == 2


def test_word_operators_start_no_job_and_do_not_shuffle_text(spark):
    grouped = spark.range(1000).groupBy("id").count().selectExpr("id AS doc_id", "cast(count AS string) AS text")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    df = words.word_count(grouped)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == before
    assert plan(words.words(tables.documents(spark, SF))).count("Exchange") == 0
    assert plan(words.word_count(words.lines(tables.documents(spark, SF)))).count("Exchange ") == 1
    assert df.count() == 1


def test_no_sort_aggregate_over_points(spark, monkeypatch):
    """A round's maximum is a hash aggregate; only tied points are sorted."""
    from spreadkit.operators import centers

    pts = tables.lineitem_points(spark, SF).withColumn("d2", F.rand(1)).withColumn("g", F.lit(0))
    p = plan(pts.groupBy("g").agg(F.max("d2").alias("largest")))
    assert "SortAggregate" not in p and "HashAggregate" in p
    assert "max_by" not in open(centers.__file__).read()


def test_word_count_partial_aggregation(spark):
    p = plan(words.word_count(tables.documents(spark, SF)))
    assert p.count("Exchange ") == 1
    assert "partial_count" in p
    assert "lang" not in p.split("ReadSchema")[-1]


def test_no_python_evaluation_anywhere(spark):
    for name in ("word_count", "class_count", "pairwise_distance", "avg_pairwise_distance",
                 "sampled_diameter", "read_points", "read_labelled", "tokenize"):
        p = plan(queries.QUERIES[name](spark, SF))
        assert "EvalPython" not in p and "PythonUDF" not in p, name
