"""Connected components of a graph held as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import stored

JUMPS = 3


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every end of a link (a, b); the component is its least node.

    In each round a node takes the least of its neighbours, if that is less, and then the
    one that took, some steps on. Links are carried over to what their ends took until none
    joins two different ones. Only tables of nodes and links are held, written between rounds.
    """
    links = links.select("a", "b").where("a <> b")
    found = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    found = stored(found.withColumn("component", F.col("node")), "components")
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    while not edges.isEmpty():
        taken = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("to"))
        taken = stored(taken, "taken")
        for _ in range(JUMPS):
            onward = taken.select(F.col("node").alias("to"), F.col("to").alias("further"))
            taken = taken.join(onward, "to", "left").select("node", F.coalesce("further", "to").alias("to"))
        taken = stored(taken, "taken")

        def moved(table: DataFrame, column: str, taken: DataFrame = taken) -> DataFrame:
            step = taken.select(F.col("node").alias(column), "to")
            return table.join(step, column, "left").withColumn(column, F.coalesce("to", column)).drop("to")

        found = stored(moved(found, "component"), "components")
        ends = moved(moved(edges, "a"), "b").where("a <> b")
        edges = stored(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return found.select("node", "component")
