"""Connected components of an edge table, by minimum labels and pointer jumping; nothing comes to the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pennant.llm.common import written


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """``id``, ``label`` (the smallest id reachable) for every id that occurs in ``edges(a, b)``.

    Each round takes the smallest label among the neighbours and then the label of that label, so the number of
    rounds grows with the logarithm of a component's width.  Every round is written to the shared folder.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), f"{name}-edges")
    nodes = written(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), f"{name}-0")
    turn = 0
    while True:
        turn += 1
        heard = both.join(nodes.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("heard"))
        best = nodes.join(heard, "id").select("id", F.col("label").alias("was"), F.least("label", "heard").alias("near"))
        up = nodes.select(F.col("id").alias("near"), F.col("label").alias("far"))
        new = written(best.join(up, "near").select("id", F.least("near", "far").alias("label"), (F.least("near", "far") < F.col("was")).alias("moved")),
                      f"{name}-{turn}")
        nodes = new.select("id", "label")
        if not new.where("moved").limit(1).count():
            return nodes
