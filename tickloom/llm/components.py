"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.store import Steps, kept


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every end of the edges ``a, b``: the smallest identifier of its component. A stored table.

    Rounds of large and small stars: every vertex links its neighbours to the smallest one it knows, first the larger
    neighbours and then the smaller ones, until every component is a star. A round is two aggregations, which combine before the
    shuffle, and two joins; the number of rounds grows with the logarithm of the longest path. Each round is stored and replaces
    the one before. Loops and repeated edges are allowed; an empty table gives an empty one.
    """
    ends = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    with Steps(edges.sparkSession) as step:
        links = step(ends)
        while True:
            half = step(_stars(links, both=True))
            step.over(links)
            links = step(_stars(half, both=False))
            step.over(half)
            # Done when every vertex has one link, to a vertex that has none: then all are stars.
            tops = links.select(F.col("b").alias("a")).distinct().join(links.select("a"), "a", "left_semi")
            if tops.isEmpty() and links.groupBy("a").count().where("count > 1").isEmpty():
                break
        roots = links.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "id")
        loners = edges.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        return kept(loners.join(roots, "id", "left").select("id", F.coalesce("root", "id").alias("root")))


def _stars(links: DataFrame, both: bool) -> DataFrame:
    """Edges (larger, smaller) after one star operation on edges (larger, smaller)."""
    if both:  # large star: neighbours above a vertex go to the smallest of its neighbours and itself
        near = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = near.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        moved = near.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:  # small star: a vertex and its neighbours below go to the smallest of these
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        moved = links.join(least, "a").select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()
