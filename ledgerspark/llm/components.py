"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, staged


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Smallest label reachable from each node.

    ``nodes``: node (long, unique), label (a struct of longs, among them ``node``, the node that it came from).
    ``edges``: a, b (long), in either direction, repeated or not. Returns node, label for every node.

    Each round takes the smallest label among a node and its neighbours and then the label of the node that this label
    came from, so that distances halve. Work is kept to nodes that have an edge. Both sides of every join are read
    from a table, so adaptive execution may split a hot key; minima are summed up before their shuffle. Rounds end when
    no label changes. Lineage is cut after each round.
    """
    both = edges.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    both = staged(both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"))), "edges")
    if both.isEmpty():
        return nodes.select("node", "label")
    linked = staged(nodes.join(both.select(F.col("src").alias("node")).distinct(), "node", "left_semi"), "labels")
    labels, before = linked, None
    while True:
        with scratch(nodes.sparkSession):
            labels = jumped(both, labels)
        # labels only ever fall: if the first field's sum stays, none of that field fell, then the same for the next
        now = labels.agg(*[F.sum(F.col(f"label.{part}").cast("decimal(20,0)")) for part in labels.schema["label"].dataType.names]).first()
        if now == before:
            break
        before = now
    rest = nodes.join(labels.select("node"), "node", "left_anti")
    return rest.select("node", "label").unionByName(labels.select("node", "label"))


def jumped(both: DataFrame, labels: DataFrame) -> DataFrame:
    """One round: the smallest label heard, then that of the node which it came from."""
    heard = both.join(labels, F.col("src") == F.col("node")).groupBy("dst").agg(F.min("label").alias("label"))
    nearest = staged(
        labels.select("node", "label")
        .unionByName(heard.select(F.col("dst").alias("node"), "label"))
        .groupBy("node")
        .agg(F.min("label").alias("label")),
        "labels",
    )
    root = nearest.select(F.col("node").alias("root"), F.col("label").alias("root_label"))
    return staged(
        nearest.join(root, F.col("label.node") == F.col("root")).select("node", F.col("root_label").alias("label")),
        "labels",
        keep=True,
    )
