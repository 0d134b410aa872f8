"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgelake.llm.common import stored


def lowest_neighbours(links: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours, as (node, parent)."""
    both = links.union(links.select("b", "a"))
    return both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("parent"))


def replaced(rows: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    """``column`` through the map (node, parent); values without an entry stay."""
    renamed = parents.select(F.col("node").alias("of"), F.col("parent").alias("to"))
    rows = rows.join(renamed, F.col(column) == F.col("of"), "left")
    return rows.withColumn(column, F.coalesce("to", column)).drop("of", "to")


def roots(parents: DataFrame) -> DataFrame:
    """The map followed to its end: each step doubles the length of the path it stands for."""
    while True:
        further = stored(replaced(parents, "parent", parents), "roots")
        moved = further.join(
            parents.withColumnRenamed("parent", "former"), "node"
        ).filter("parent <> former")
        if moved.isEmpty():
            return further
        parents = further


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node it can reach.

    Every round, each node points at its smallest neighbour, the pointers are followed to their
    ends, and the links are redrawn between these ends. Only tables that follow the number of
    links exist; each round is written to the shared folder. A node with very many links costs
    no task more than others: its minimum is formed before the shuffle, and the joins are plain
    ones between stored tables, whose heavy keys Spark splits.
    """
    links = stored(links.filter("a <> b").distinct(), "links")
    labels = stored(
        links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
        .withColumn("component", F.col("node")),
        "labels",
    )
    while not links.isEmpty():
        ends = roots(stored(lowest_neighbours(links), "parents"))
        labels = stored(replaced(labels, "component", ends), "labels")
        redrawn = replaced(replaced(links, "a", ends), "b", ends)
        links = stored(redrawn.filter("a <> b").distinct(), "links")
    return labels
