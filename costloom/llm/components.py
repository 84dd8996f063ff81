"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costloom.llm.storage import stored


def connected(edges: DataFrame) -> DataFrame:
    """`(id, comp)` for every id of `edges(a, b)`; comp is the smallest id that can be reached.

    Every round takes the smallest label among neighbours and then the label of that label, so long
    paths shrink quickly. Neighbours are reduced with map-side minima, so a node with very many
    edges is no single task. Each round is stored; nothing is collected.
    """
    both = stored(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges",
    )
    label = stored(
        both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("comp")),
        "labels",
    )
    while True:
        near = (
            both.join(label.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("comp").alias("near"))
        )
        step = label.join(near, "id").select("id", F.col("comp").alias("old"), F.least("comp", "near").alias("comp"))
        jump = label.select(F.col("id").alias("comp"), F.col("comp").alias("jump"))
        step = stored(
            step.join(jump, "comp", "left").select("id", "old", F.coalesce("jump", "comp").alias("comp")), "labels"
        )
        label = step.select("id", "comp")
        if step.filter("old <> comp").isEmpty():
            return label
