"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of (a, b): root is the least node that it is linked with, over any number of links.

    Every edge points from the larger node to the smaller. A round first hangs each node below the least parent of its
    parent, then all parents of a node below the least of them; it ends when each node has one parent that has none. The
    number of rounds grows as the logarithm of a component's width. Nothing but counts reaches the driver."""
    e = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        least = e.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("n"))
        up = least.select(F.col("a").alias("b"), F.col("m").alias("up"))
        open_ = not e.join(up, "b").isEmpty() or not least.where("n > 1").isEmpty()
        if not open_:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        raised = e.join(up, "b", "left").select("a", F.coalesce("up", "b").alias("b")).distinct()
        lowest = raised.groupBy("a").agg(F.min("b").alias("m"))
        # The parents of a node hang below the least of them, and so does the node.
        flat = raised.join(lowest, "a").select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        new = materialise(flat.where("a <> b").distinct(), "edges")
        discard(e)
        e = new
