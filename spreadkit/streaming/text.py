"""The text-line source (S1) on a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``value string`` per line of every new file in ``path``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)
