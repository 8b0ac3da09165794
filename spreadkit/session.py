"""A local session for tests, the benchmark and the examples.

On a cluster the caller builds the session; nothing in the operators depends
on this module.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = 8,
    shuffle_partitions: int = 8,
    app: str = "spreadkit",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A ``local[cores]`` session; ``conf`` adds or overrides settings
    (for example an event log folder when profiling)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spreadkit-ckpt-"))
    return spark
