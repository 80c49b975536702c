"""Connected components of a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ._shared import discard, stored


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node reached) for every node of the edges ``a``, ``b``.

    Every round gives each node the least label among its own, its neighbours'
    and its label's label, so paths shrink by doubling; labels are written to
    the shared folder after each round, and those of the round before
    deleted.  Rows are only ever aggregated by least value, which combines before the
    shuffle; both sides of the joins come from tables, so the adaptive join can split a hub's rows.
    """
    both = stored(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = stored(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.lit(None).cast("long").alias("old"), F.least("a", "m").alias("label")))
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = labels.select("node", "label").join(seen, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = stored(step.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("next", "label")).alias("label")))
        discard(labels)
        labels = after
        if labels.where("old != label").isEmpty():
            discard(both)
            return labels.select("node", F.col("label").alias("component"))
