"""Connected components of an edge table, as shuffles and joins.

Minimum-label propagation with pointer jumping: in each round a node takes the
smallest label among itself and its neighbours, then the label of its label.
Labels at least halve their distance to the root, so the number of rounds
grows with the logarithm of the longest path. Every round is stored in the
shared folder, so lineage stays short and a lost executor re-reads files.
Aggregations by node combine map-side; a hot node is only a hot join key,
which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import stored


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, root) for every node of ``edges``; ``root`` is the smallest node reachable.

    Null ends are ignored; loops and repeated or reversed edges do not matter.
    An empty edge table gives an empty result.
    """
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    both = stored(e.union(e.select("b", "a")).where("a <> b").distinct(), "cc-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root")), "cc-labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        own = labels.select("node", F.col("root").alias("old"))
        step = own.join(near, "node", "left").select("node", "old", F.least("old", F.coalesce("near", "old")).alias("mid"))
        up = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        new = step.join(up, "mid", "left").select(
            "node", "old", F.least("mid", F.coalesce("far", "mid")).alias("root")
        )
        new = stored(new, "cc-labels")
        labels = new.select("node", "root")
        if new.where("old <> root").isEmpty():
            return labels
