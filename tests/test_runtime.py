import os

from pyspark.sql import functions as F

from spreadkit.runtime import BROADCAST_CONF, ensure_checkpoint_dir, fits_broadcast, remove_path, stored, work_path


def test_checkpoint_dir_is_read_from_the_session(spark):
    folder = ensure_checkpoint_dir(spark)
    assert folder and folder == spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == folder  # never replaced once set


def test_stored_cuts_lineage(spark):
    df = spark.range(100).withColumn("x", F.col("id") * 2).groupBy((F.col("id") % 3).alias("k")).count()
    out = stored(df, "test")
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, df.collect()))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan  # read back, not recomputed


def test_remove_path(spark):
    path = work_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.exists(path.removeprefix("file:"))
    remove_path(spark, path)
    assert not os.path.exists(path.removeprefix("file:"))


def test_broadcast_cap_is_configurable(spark):
    old = spark.conf.get(BROADCAST_CONF, None)
    try:
        spark.conf.set(BROADCAST_CONF, "1000")
        assert fits_broadcast(spark, 10, 100) and not fits_broadcast(spark, 11, 100)
    finally:
        if old is None:
            spark.conf.unset(BROADCAST_CONF)
        else:
            spark.conf.set(BROADCAST_CONF, old)
