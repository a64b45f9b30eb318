"""Connected components of an undirected graph, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.work import staged

MAX_ROUNDS = 100


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a``, ``b``, both long): ``label`` is the smallest node reachable.

    Each round every node takes the smallest label among itself and its neighbours, then the label of its label, so
    chains shorten to about half and stars end in one round. Each round's labels are written to the shared folder. Ends
    when a round changes nothing; raises beyond :data:`MAX_ROUNDS` instead of returning half-joined components.
    """
    # both directions from one reading: edges made by Python may be others (of the same components) when made again
    there, back = F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))
    both = staged(edges.where("a != b").select(F.inline(F.array(there, back))).distinct(), "edges")
    labels = staged(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label")).withColumnRenamed("a", "node"), "labels")
    for _ in range(MAX_ROUNDS):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        taken = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", "label", F.least("label", "near").alias("next")
        )
        of_label = labels.select(F.col("node").alias("next"), F.col("label").alias("jump"))
        jumped = taken.join(of_label, "next", "left").select(
            "node", F.least("next", F.coalesce("jump", "next")).alias("label"), F.col("label").alias("old")
        )
        after = staged(jumped, "labels")
        changed = after.where("label != old").limit(1).count()
        labels = after.select("node", "label")
        if not changed:
            return labels
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
