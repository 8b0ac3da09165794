"""Point source (S3): lines of comma-separated doubles -> ``id, vec``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spreadkit.sources.labelled import check_lines

VECTOR = T.ArrayType(T.DoubleType())


def parse_points(
    lines: DataFrame,
    id_col: str,
    line: str = "value",
    mode: str = "strict",
) -> DataFrame:
    """Parse ``"1.5,2,3"`` into ``id, vec array<double>``; the lines bring the id.

    Trailing commas are dropped (``"1,2,"`` is ``(1, 2)``); an empty line, an
    empty inner field, a non-number or a non-finite value (``NaN``,
    ``Infinity``) is malformed: an error in strict mode, left out in permissive
    mode and the whole result in mode ``rejected``.
    """
    text = F.regexp_replace(F.col(line), r",+$", "")
    parts = F.split(text, ",", -1)
    coords = F.transform(parts, lambda s: s.try_cast("double"))
    staged = lines.withColumn("__v", coords)
    bad_value = F.exists(
        F.col("__v"),
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    valid = F.col(line).isNotNull() & (F.trim(text) != F.lit("")) & ~bad_value
    checked = check_lines(staged, valid, "point", F.col(line), mode)
    if mode == "rejected":
        return checked.select(*lines.columns)
    return checked.select(F.col(id_col).alias("id"), F.col("__v").alias("vec"))


def points_from_columns(df: DataFrame, id_expr, columns: list[str]) -> DataFrame:
    """Build ``id, vec`` from numeric columns of a table (no text round trip)."""
    vec = F.array(*[F.col(c).cast("double") for c in columns]).cast(VECTOR)
    return df.select(id_expr.alias("id"), vec.alias("vec"))
