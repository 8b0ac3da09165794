"""Session-level helpers shared by the operators.

Three concerns live here and nowhere else:

* the shared folder for written tables (``spark.checkpoint.dir``),
* how large a side may be before it is no longer broadcast,
* what an iterative operator keeps in executor memory between rounds.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Default cap for any side this package broadcasts on its own. A side is only
# broadcast after its size has been computed from a counted row number and a
# known row width; beyond the cap the operators switch to a shuffled plan.
DEFAULT_BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_CONF = "spreadkit.broadcast.maxBytes"


def broadcast_limit(spark: SparkSession) -> int:
    value = spark.conf.get(BROADCAST_CONF, None)
    return int(value) if value else DEFAULT_BROADCAST_BYTES


def fits_broadcast(spark: SparkSession, rows: int, row_bytes: int) -> bool:
    """True when ``rows`` rows of ``row_bytes`` bytes stay under the cap."""
    return rows * max(row_bytes, 1) <= broadcast_limit(spark)


def vector_row_bytes(dim: int, extra_columns: int = 2) -> int:
    """Rough in-memory width of a row carrying one ``array<double>`` of ``dim``."""
    return 8 * dim + 16 + 8 * extra_columns


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, as configured on the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; it is read,
    never replaced. Only a local-mode session without one (tests, laptops) gets
    a private temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if sc.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="spreadkit-ckpt-")
        sc.setCheckpointDir(folder)
        return sc.getCheckpointDir() or folder
    raise RuntimeError(
        "spark.checkpoint.dir is not set; iterative operators need a shared "
        "folder to checkpoint into"
    )


def _filesystem(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def work_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    files, hadoop = _filesystem(spark, path)
    files.deleteOnExit(hadoop)
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    files, hadoop = _filesystem(spark, path)
    files.delete(hadoop, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back:
    computed in one pass, no lineage, safe when executors are lost."""
    path = work_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cached(df: DataFrame) -> DataFrame:
    """Persist ``df`` (memory, spilling to disk) for an operator's several passes.

    Lost blocks are recomputed from lineage, so this is safe under executor
    loss; callers unpersist when their loop ends.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def here(df: DataFrame) -> DataFrame:
    """``df`` computed now and held as a local relation: for a few rows whose size
    has been checked, which the next plans then read without a job."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)
