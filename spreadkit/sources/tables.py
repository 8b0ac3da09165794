"""Projections of the parquet test tables onto the reference's inputs.

Each function reads only the columns it needs, so the parquet scan prunes
everything else. The mapping (which column plays key, class, text or point)
is the one given in FIXTURES.md.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadkit.sources.points import VECTOR, points_from_columns

LINEITEM_COORDINATES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, class`` from ``events`` (event_id, event_type)."""
    events = table(spark, sf_dir, "events")
    return events.select(F.col("event_id").alias("key"), F.col("event_type").alias("class"))


def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` rendered as ``"<event_id> <event_type>"`` text lines."""
    events = table(spark, sf_dir, "events")
    return events.select(F.concat_ws(" ", "event_id", "event_type").alias("value"))


def labelled_lines_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`labelled_lines`, but every seventh event has lost its class."""
    events = table(spark, sf_dir, "events")
    cls = F.when(F.pmod("event_id", F.lit(7)) != 0, F.col("event_type"))
    return events.select(F.concat_ws(" ", "event_id", cls).alias("value"))


def returnflags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, class`` from ``lineitem`` with ``l_returnflag`` as the class."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(lineitem_id().alias("key"), F.col("l_returnflag").alias("class"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, text`` from ``documents``; one row is one document."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-D points: ``id = vec_id``, ``vec = embedding`` as doubles."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select(
        F.col("vec_id").alias("id"), F.col("embedding").cast(VECTOR).alias("vec")
    )


# Room for each part of a lineitem's identity: 10^9 parts and suppliers (scale
# factor 5,000 and 100,000), 10 line numbers, quantities to 99; 17 digits are
# left for the order.
ID = "decimal(38,0)"


def lineitem_id() -> Column:
    """Unique row id of ``lineitem``: its four keys and the quantity side by side
    in one decimal number (in this data two rows may share all four keys)."""
    room = lambda c, power: F.col(c).cast("decimal(17,0)") * F.lit(Decimal(10**power))
    return (
        room("l_orderkey", 21) + room("l_partkey", 12) + room("l_suppkey", 3) + room("l_linenumber", 2)
        + F.col("l_quantity").cast("decimal(2,0)")
    ).cast(ID)


def lineitem_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-D points (quantity, extended price, discount, tax) keyed by ``lineitem_id``."""
    li = table(spark, sf_dir, "lineitem")
    return points_from_columns(li, lineitem_id(), LINEITEM_COORDINATES)


def lineitem_lines(spark: SparkSession, sf_dir: str, sort: bool = False) -> DataFrame:
    """``lineitem`` rendered as ``"q,p,d,t"`` lines, with the row id alongside;
    ``sort`` orders them by their numbers."""
    li = table(spark, sf_dir, "lineitem")
    li = li.orderBy(*LINEITEM_COORDINATES) if sort else li
    return li.select(
        lineitem_id().alias("id"),
        F.concat_ws(",", *[F.col(c).cast("string") for c in LINEITEM_COORDINATES]).alias("value"),
    )
