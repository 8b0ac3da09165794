"""Reading the given tables, and giving this package to the Python workers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

import spreadkit
from spreadkit.runtime import stored, work_path

__all__ = ["read", "ship_package", "stored", "work_path"]

# Texts make wide rows: Spark's default of 64 MiB an Arrow batch is held several
# times over by each task, in the JVM and in its worker. Set only while the
# session has the default.
BATCH_BYTES = 8 << 20
_BATCH_CONF, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for a Spark application, so
    they need no installed copy; bound the Arrow batches of the session."""
    sc = spark.sparkContext
    if spark.conf.get(_BATCH_CONF, None) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    if getattr(sc, "_spreadkit_shipped", False):
        return
    top = os.path.dirname(os.path.abspath(spreadkit.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="spreadkit-"), f"spreadkit-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._spreadkit_shipped = True


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
