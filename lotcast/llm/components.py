"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotcast.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (smallest node reachable) for every node of
    ``edges`` (``a``, ``b``: long).

    Each round sends every node to the smallest of its neighbours and
    itself, follows that pointer once more, and replaces the edges by the
    distinct edges between the images; a star of any size is gone after one
    round. The smallest node of a component always maps to itself, so it is
    what remains. All sums and joins are over edges that shrink from round to
    round; a hot node's edges are pre-aggregated before each shuffle.
    """
    edges = materialize(edges.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .distinct(), "edges")
    labels = None
    while edges.take(1):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = both.groupBy("a").agg(F.least("a", F.min("b")).alias("to"))
        step = materialize(step, "component-step")
        jump = step.select(F.col("a").alias("to"), F.col("to").alias("further"))
        step = materialize(step.join(jump, "to", "left")
                           .select("a", F.coalesce("further", "to").alias("to")), "component-jump")
        if labels is None:
            labels = step.select(F.col("a").alias("node"), F.col("to").alias("label"))
        else:
            labels = labels.join(step.select(F.col("a").alias("label"), "to"), "label", "left") \
                .select("node", F.coalesce("to", "label").alias("label"))
        labels = materialize(labels, "component-labels")
        to_a = step.select("a", F.col("to").alias("x"))
        to_b = step.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = materialize(edges.join(to_a, "a").join(to_b, "b").filter("x != y")
                            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
