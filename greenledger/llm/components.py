"""Connected components as Spark jobs: smallest label of the neighbours, then a
jump to the label's own label, until no neighbour has a smaller one. Hubs are dealt out by the
salted lookup; every round is a written table, so lineage stays short."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach, planned_once, staged


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the component is its
    smallest node. No links give an empty table."""
    with planned_once(links.sparkSession):
        return _smallest_labels(links)


def _smallest_labels(links: DataFrame) -> DataFrame:
    edges = staged(links.select("a", "b").union(links.select("b", "a")).distinct().toDF("node", "other"), "edges")
    labels = staged(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), "labels")
    while True:
        near = attach(edges, labels.select(F.col("node").alias("other"), "component"), ["other"], "node")
        both = (near.select("node", "component", F.lit(None).cast("long").alias("before"))
                .unionByName(labels.withColumn("before", F.col("component"))))
        moved = staged(both.groupBy("node").agg(F.min("component").alias("component"), F.max("before").alias("before")), "moved")
        if moved.filter("component <> before").isEmpty():  # neighbours have one label, so components do
            return labels
        jump = moved.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = staged(attach(moved, jump, ["component"], "node")
                        .select("node", F.least("component", "further").alias("component")), "labels")
