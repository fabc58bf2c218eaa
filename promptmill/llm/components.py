"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promptmill.workspace import materialize


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): every node of an edge with the least node of its component.

    Each round, a node takes the least label among itself and its neighbours,
    then the label of that label. Minima are combined before they are shuffled,
    so a node with very many edges is no more work than the edges are; only
    tables as long as the nodes or edges are written, none goes to the driver.
    """
    once = materialize(edges.select(F.col(a).alias("from"), F.col(b).alias("to")).distinct(), "edges")
    both = once.union(once.select("to", "from"))
    labels = materialize(
        both.groupBy("from").agg(F.min("to").alias("to")).select(
            F.col("from").alias("node"), F.least("from", "to").alias("label")
        ),
        "labels",
    )
    while True:
        told = both.join(labels.withColumnRenamed("node", "from"), "from").groupBy("to").agg(F.min("label").alias("near"))
        nearer = labels.join(told, F.col("node") == F.col("to"), "left").select(
            "node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("new")
        )
        nearer = materialize(nearer, "labels")
        heads = nearer.select(F.col("node").alias("head"), F.col("new").alias("further"))
        jumped = nearer.join(heads, F.col("new") == F.col("head"), "left").select(
            "node", "old", F.least("new", F.coalesce("further", "new")).alias("label")
        )
        jumped = materialize(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.where("old <> label").isEmpty():
            return labels
