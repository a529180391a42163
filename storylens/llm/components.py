"""Connected components of a graph given as a table of edges, without a driver-side copy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storylens.llm.common import written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``(a, b)`` edges; root is the smallest node that it reaches.

    Alternates two steps. In the first each node hands its smallest known
    neighbour, itself included, to its larger neighbours; in the second to its
    smaller ones. Both keep what is reachable, and the edges end up as stars
    around the smallest nodes, after a logarithmic number of rounds. A hub is
    one row of the minima, and its edges stay where a skewed join can split
    them. Each round is written to the shared folder.
    """
    stars = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .distinct(), name)
    size = _signature(stars)
    while size[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _handed_on(both, "b > a")
        # b < a in all rows from here on: a points to a smaller node
        small = _handed_on(written(large, name), None)
        stars = written(small, name)
        new = _signature(stars)
        if new == size:
            break
        size = new
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _handed_on(pairs: DataFrame, keep: str | None) -> DataFrame:
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    joined = pairs.join(least, "a")
    handed = (joined.where(keep) if keep else joined).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if keep is None:  # the node itself hangs on its smallest neighbour, too
        handed = handed.unionByName(least.select("a", F.col("m").alias("b")))
    return handed.where("a <> b").distinct()


def _signature(stars: DataFrame) -> tuple:
    """Equal for equal sets of edges: their number, and an order-free sum of their hashes."""
    r = stars.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return r[0], r[1]
