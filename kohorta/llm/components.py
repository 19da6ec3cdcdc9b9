"""Connected components of a graph given by edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kohorta.llm.common import durable


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge in ``edges`` (columns a, b).

    Each round every node moves to the least node among itself and its
    neighbours, and the graph is contracted. "Least" is by name in even rounds,
    which settles stars at once, and by a hash that changes in odd rounds, which
    shortens any path by a constant share. Each round is written to the shared
    folder; nothing is gathered, and a hub is reduced before it is shuffled.
    """
    current = durable(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    steps: list[DataFrame] = []
    while not current.isEmpty():
        order = F.lit(0).cast("long") if len(steps) % 2 == 0 else F.xxhash64("to", F.lit(len(steps)))
        reach = current.select(F.col("a").alias("node"), F.explode(F.array("a", "b")).alias("to")).union(
            current.select(F.col("b").alias("node"), F.explode(F.array("a", "b")).alias("to"))
        )
        step = reach.groupBy("node").agg(F.min(F.struct(order.alias("o"), F.col("to"))).alias("m"))
        step = durable(step.select("node", F.col("m.to").alias("parent")))
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        right = step.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        moved = current.join(left, "a").join(right, "b").filter(F.col("pa") != F.col("pb"))
        current = durable(
            moved.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct()
        )
    if not steps:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = steps[0].select("node", F.col("parent").alias("root"))
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), "parent")
        roots = roots.join(later, "root", "left").select("node", F.coalesce("parent", "root").alias("root"))
    return durable(roots)
