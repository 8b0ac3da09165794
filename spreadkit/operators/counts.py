"""Counting operators over labelled pairs.

Every operator is a plain aggregate. Catalyst splits each ``groupBy`` into a
partial aggregate before the shuffle and a final one after it, which is the
per-partition ``HashMap`` combine the reference writes by hand; a class that
holds a third of all rows therefore costs one row per map task in the
shuffle, not a third of the data in one reducer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spreadkit.functions.keys import bucket
from spreadkit.runtime import stored


def class_count(
    df: DataFrame,
    key: str = "key",
    cls: str = "class",
    strategy: str = "direct",
    buckets: int = 8,
) -> DataFrame:
    """``class, cnt`` for every class (A2, A3).

    ``direct``: one aggregate, one exchange.
    ``two_round``: count per ``(key % buckets, class)`` first, then add the
    bucket counts per class; two exchanges. The first round bounds what any
    reducer sees by the bucket, which is the reference's explicit defence
    against a hot class.
    """
    if strategy == "direct":
        counts = df.groupBy(F.col(cls).alias("class")).agg(F.count(F.lit(1)).alias("cnt"))
    elif strategy == "two_round":
        per_bucket = df.groupBy(
            bucket(key, buckets).alias("bucket"), F.col(cls).alias("class")
        ).agg(F.count(F.lit(1)).alias("cnt"))
        counts = per_bucket.groupBy("class").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    else:
        raise ValueError("strategy must be 'direct' or 'two_round'")
    return counts


def sorted_by_class(counts: DataFrame, cls: str = "class") -> DataFrame:
    """Total order by class name (O1), UTF-8 byte order."""
    return counts.orderBy(F.col(cls).asc())


def most_frequent(counts: DataFrame, cls: str = "class", cnt: str = "cnt") -> DataFrame:
    """The class with the largest count; a tie goes to the smallest name (A5).

    Planned as a top-1 (each task keeps its best row), not a global sort.
    """
    return counts.orderBy(F.col(cnt).desc(), F.col(cls).asc()).limit(1)


def partition_sizes(df: DataFrame, by: Column | str | None = None) -> DataFrame:
    """``partition, size`` per partition.

    ``by=None`` profiles the physical Spark partitions (``spark_partition_id``);
    a column or expression gives the reproducible logical form, e.g.
    ``partition_number('key', K)``.
    """
    if by is None:
        part = F.spark_partition_id()
    else:
        part = F.col(by) if isinstance(by, str) else by
    return df.groupBy(part.alias("partition")).agg(F.count(F.lit(1)).alias("size"))


def max_partition_size(df: DataFrame, by: Column | str | None = None) -> DataFrame:
    """Largest partition size (A4), one row ``max_partition_size``."""
    sizes = partition_sizes(df, by)
    return sizes.agg(F.max("size").alias("max_partition_size"))


def balance(df: DataFrame) -> DataFrame:
    """What holds of any balanced redistribution (X1): one row ``partitions,
    n_rows, balanced``, where ``balanced`` says that no partition has more than
    twice the mean."""
    sizes = partition_sizes(df)
    total = sizes.agg(F.count(F.lit(1)).alias("partitions"), F.sum("size").cast("bigint").alias("n_rows"), F.max("size").alias("most"))
    return total.select("partitions", "n_rows", (F.col("most") * F.col("partitions") <= 2 * F.col("n_rows")).alias("balanced"))


def exact_split(df: DataFrame, k: int) -> DataFrame:
    """``df`` in ``k`` partitions whose sizes differ by at most one.

    The rows are written once; a row's rank is its place in its file plus the
    sizes of the parts before it (one row a part), and rank ``r`` goes to
    partition ``r % k``. No key decides, so no key can make a partition large.
    """
    if k < 1:
        raise ValueError("the number of partitions must be positive")
    rows = stored(df, "split").withColumn("__m", F.monotonically_increasing_id())
    sizes = rows.groupBy(F.shiftright("__m", 33).alias("__part")).agg(F.count(F.lit(1)).alias("n"), F.min("__m").alias("first"))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("__part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("__shift"))
    ranked = rows.withColumn("__part", F.shiftright("__m", 33)).join(F.broadcast(shifts), "__part")
    target = F.pmod(F.col("__m") + F.col("__shift"), F.lit(k)).cast("int")
    return ranked.withColumn("__to", target).repartitionById(k, "__to").select(*df.columns)
