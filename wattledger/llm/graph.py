"""Connected components by contraction, with every step a join on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattledger.llm.common import Run


def components(edges: DataFrame, run: Run) -> DataFrame:
    """Smallest node reachable from every node that has a link.

    ``edges``: longs (a, b). Returns (node, component), one row per node; nodes without links
    are absent, null ends and loops are ignored. Each step hangs every node under its smallest
    neighbour, follows those pointers to their end and merges what hangs together, so that the
    graph at least halves; hot nodes meet only map-side combined minima and joins.
    """
    one = edges.filter("a is not null and b is not null and a <> b")
    current = run.store(one.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while current.limit(1).count():
        both = current.select("a", "b").union(current.select("b", "a"))
        parent = run.store(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
            .select("node", F.least("node", "m").alias("parent")), "parent")
        while True:  # pointers to their end: twice as far each time
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("top"))
            jumped = run.store(
                parent.join(up, "parent").select("node", F.col("top").alias("parent"), (F.col("top") != F.col("parent")).alias("moved")),
                "jump")
            moved = jumped.filter("moved").limit(1).count()
            run.drop(parent)
            parent = jumped.select("node", "parent")
            if not moved:
                break
        if labels is None:
            found = parent.select("node", F.col("parent").alias("component"))
        else:
            p = parent.select(F.col("node").alias("component"), "parent")
            found = labels.join(p, "component", "left").select("node", F.coalesce("parent", "component").alias("component"))
        stored = run.store(found, "labels")
        a, b = (parent.select(F.col("node").alias(c), F.col("parent").alias(f"p{c}")) for c in "ab")
        linked = current.join(a, "a").join(b, "b").filter("pa <> pb")
        rest = run.store(linked.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges")
        run.drop(current, parent, *([labels] if labels is not None else []))
        current, labels = rest, stored
    if labels is None:
        return run.store(run.spark.createDataFrame([], "node bigint, component bigint"), "labels")
    return labels
