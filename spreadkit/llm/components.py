"""Connected components of links between ids, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """``id, label`` for every id in ``links`` (columns ``a``, ``b``): the label
    is the smallest id reachable. Each round every id takes the smallest label
    among its neighbours' and its own, then the label of that label, which
    halves the remaining paths. Nothing but the number of changes reaches the
    driver; each round is written to the shared folder."""
    both = stored(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("label"))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("low"))
        jump = labels.select(F.col("id").alias("low"), F.col("label").alias("jump"))
        after = stored(
            lower.join(jump, "low", "left").select("id", "label", F.least("low", F.coalesce("jump", "low")).alias("next")), "labels"
        )
        changed = after.where("next < label").limit(1).count()
        labels = after.select("id", F.col("next").alias("label"))
        if not changed:
            return labels
