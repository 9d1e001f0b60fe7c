"""Connected components of an edge table, by contraction.

Each round every node points to its smallest neighbour, pointers are doubled until they reach
roots, and edges are moved to the roots; edges inside one root vanish. Pointers only lead to
smaller ids, so there are no cycles. Hubs are aggregated before the shuffle. Every table of a
round is written to the shared folder; only row counts reach the driver.

Defined results: repeated edges count once, an edge from a node to itself is none; only the columns a and b are
read; no edges give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkseries.llm.shared import written


def moved(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges (a, b) with both ends replaced by their roots; loops and copies removed."""
    one = roots.select(F.col("id").alias("a"), F.col("root").alias("ra"))
    two = roots.select(F.col("id").alias("b"), F.col("root").alias("rb"))
    ends = edges.join(one, "a", "left").join(two, "b", "left").select(
        F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y"))
    return ends.where(F.col("x") != F.col("y")).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def jumped(pointers: DataFrame) -> DataFrame:
    """Pointers (id, root) doubled until every one leads to a root."""
    while True:
        beyond = pointers.select(F.col("id").alias("root"), F.col("root").alias("next"))
        pointers = written(
            pointers.join(beyond, "root", "left").select(
                "id", F.coalesce("next", "root").alias("root"), F.coalesce(F.col("next") != F.col("root"), F.lit(False)).alias("moved")),
            "pointers")
        if pointers.where("moved").isEmpty():
            return pointers.select("id", "root")
        pointers = pointers.select("id", "root")


def components(edges: DataFrame) -> DataFrame:
    """(id, root): the smallest id reachable, for every id of the edges (a, b)."""
    edges = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("low"))
        pointers = written(nearest.select("id", F.least("id", "low").alias("root")), "pointers")
        roots = jumped(pointers)
        edges = written(moved(edges, roots), "edges")
        if labels is None:
            labels = roots
        else:
            step = roots.select(F.col("id").alias("root"), F.col("root").alias("next"))
            labels = written(labels.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root")), "labels")
    if labels is None:
        labels = edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return labels
