"""Labelled-pair source (S2): ``<int key> <class>`` lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spreadkit.functions.text import tokens

_INTEGER = r"^[+-]?[0-9]+$"


def check_lines(df: DataFrame, valid: Column, what: str, line: Column, mode: str) -> DataFrame:
    """``strict`` (the default everywhere): a bad row fails the job; the check is
    a filter, so column pruning cannot remove it. ``permissive``: the valid rows.
    ``rejected``: the rows that ``permissive`` leaves out, for counting or keeping."""
    valid = F.coalesce(valid, F.lit(False))
    if mode == "permissive":
        return df.filter(valid)
    if mode == "rejected":
        return df.filter(~valid)
    if mode != "strict":
        raise ValueError("mode must be 'strict', 'permissive' or 'rejected'")
    message = F.concat(F.lit(f"malformed {what} line: '"), F.coalesce(line, F.lit("NULL")), F.lit("'"))
    return df.filter(F.when(valid, F.lit(True)).otherwise(F.raise_error(message)))


def parse_labelled(lines: DataFrame, line: str = "value", mode: str = "strict") -> DataFrame:
    """Parse lines into ``key bigint, class string`` (other columns kept).

    The line is split on single spaces with trailing empty tokens dropped; the
    first token must be an integer, the second is the class (possibly empty,
    as in ``"5  x"``), further tokens are ignored. Keys are read as 64-bit
    integers, so keys beyond the 32-bit range are accepted. With ``mode``
    ``rejected`` the result is the malformed lines, as they are.
    """
    toks = tokens(F.col(line))
    staged = lines.withColumn("__tok", toks)
    key_text = F.col("__tok").getItem(0)
    key = key_text.try_cast("bigint")
    valid = (
        F.col(line).isNotNull()
        & (F.size("__tok") >= 2)
        & key_text.rlike(_INTEGER)
        & key.isNotNull()
    )
    checked = check_lines(staged, valid, "labelled", F.col(line), mode)
    if mode == "rejected":
        return checked.select(*lines.columns)
    others = [c for c in lines.columns if c != line]
    return checked.select(
        *others,
        F.col("__tok").getItem(0).cast("bigint").alias("key"),
        F.col("__tok").getItem(1).alias("class"),
    )
