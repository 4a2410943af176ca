"""Connected components by minimum labels and pointer jumping, as iterated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import written
from fundlens.operators.join import SizedSide

ROWS_PER_TASK = 100_000  # links of two numbers
SMALL = 2_000_000  # labels of two numbers up to which their list is broadcast


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) of undirected ``links`` (a, b): the smallest node reachable.

    Each round every node takes the smallest label among its neighbours and then
    the label of its label; labels halve their distance, so long chains take
    logarithmically many rounds.  Every round is written to the shared folder.
    Nulls and loops in ``links`` say nothing; without links the result is empty.
    """
    pairs = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    tasks = 4 + links.count() // ROWS_PER_TASK
    both = written(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links", tasks)
    start = both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component"))
    # there are as many labels in every round: a list that is small at first is broadcast in each
    first = SizedSide.of(start.coalesce(tasks), SMALL)
    labels, hint = first.frame, F.broadcast if first.small else (lambda df: df)
    for _ in range(max_rounds):
        seen = both.join(hint(labels.withColumnRenamed("node", "b")), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        lower = seen.join(hint(labels), "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        after = lower.join(hint(jump), "component", "left").select("node", "old", F.least("component", F.coalesce("further", "component")).alias("component"))
        step = written(after, "labels", tasks)
        labels = step.select("node", "component")
        if step.filter("old <> component").isEmpty():
            return labels
    raise RuntimeError("components did not settle")
