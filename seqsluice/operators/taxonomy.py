"""Taxonomy dictionaries: lineages from the tree, taxids of accessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RANKS
from ..session import settled


def merged_nodes(nodes: DataFrame, merged: DataFrame) -> DataFrame:
    """nodes (taxid, parent, rank) with those that were merged into another taking its parent and rank, along the whole chain of merges."""
    chain = merged.select(F.col("old").alias("taxid"), F.col("new").alias("target")).where("old <> new")
    while True:  # chains are short; each round halves them
        step = chain.select(F.col("taxid").alias("target"), F.col("target").alias("next"))
        if chain.join(step, "target", "left_semi").isEmpty():
            break
        chain = settled(chain.join(step, "target", "left").select("taxid", F.coalesce("next", "target").alias("target")).where("taxid <> target"))
    to = chain.join(nodes.select(F.col("taxid").alias("target"), F.col("parent").alias("p"), F.col("rank").alias("r")), "target").select("taxid", "p", "r")
    rows = nodes.join(to, "taxid", "left")
    return rows.select("taxid", F.coalesce("p", "parent").alias("parent"), F.coalesce("r", "rank").alias("rank"))


def lineages(nodes: DataFrame) -> DataFrame:
    """(taxid, species, genus, family) of every node: of each rank the topmost node on the way to the root, itself included; -1 without one.

    Pointer doubling: after k rounds a node knows 2^k steps of its way, so the number of rounds is the logarithm of the depth,
    whatever that is. Each round is one join of the table with itself; the first without a node on its way is the last. A tree
    that is deeper than a round has nodes that end in the next one; where none does, those left lead into cycles. A way into a cycle ends before the first node that it would meet again."""
    rank = {r: F.when(F.col("rank") == r, F.col("taxid")) for r in RANKS}
    table = nodes.select("taxid", F.col("parent").alias("up"), *[rank[r].alias(r) for r in RANKS])
    open_ = nodes.count()
    while open_:
        above = table.select(F.col("taxid").alias("up"), F.col("up").alias("up2"), *[F.col(r).alias(f"up_{r}") for r in RANKS])
        table = settled(table.join(above, "up", "left").select("taxid", F.col("up2").alias("up"), *[F.coalesce(f"up_{r}", r).alias(r) for r in RANKS]))
        before, open_ = open_, table.where("up IS NOT NULL").count()
        if open_ == before:
            table = table.where("up IS NULL").select("taxid", *RANKS).unionByName(_walked(nodes, table.where("up IS NOT NULL").select("taxid")))
            break
    return table.select("taxid", *[F.coalesce(r, F.lit(-1)).cast("int").alias(r) for r in RANKS])


def _walked(nodes: DataFrame, some: DataFrame) -> DataFrame:
    """The same for nodes whose ways lead into cycles, step by step: (taxid, species, genus, family), null without one."""
    step = settled(nodes.select(F.col("taxid").alias("at"), "parent"))
    ways = some.select("taxid", F.array("taxid").alias("way"))
    while True:
        ways = ways.withColumn("at", F.element_at("way", -1)).join(step, "at", "left").select("taxid", "way", F.when(~F.array_contains("way", F.col("parent")), F.col("parent")).alias("up"))
        ways = settled(ways.join(step.select(F.col("at").alias("up"), F.lit(True).alias("there")), "up", "left"))
        if ways.where("there").isEmpty():
            break
        ways = ways.select("taxid", F.when(F.col("there"), F.concat("way", F.array("up"))).otherwise(F.col("way")).alias("way"))
    on = ways.select("taxid", F.posexplode("way").alias("d", "at")).join(nodes.select(F.col("taxid").alias("at"), "rank"), "at")
    return on.groupBy("taxid").agg(*[F.max_by("at", F.when(F.col("rank") == r, F.col("d"))).alias(r) for r in RANKS])


def lineages_recursive(nodes: DataFrame, depth: int = 100) -> DataFrame:
    """The same by a recursive query, for trees within Spark's limit of rows of one."""
    nodes.createOrReplaceTempView("_nodes")
    picks = ", ".join(f"coalesce(max_by(node, d) FILTER (WHERE rank = '{r}'), -1) AS {r}" for r in RANKS)
    return nodes.sparkSession.sql(f"""WITH RECURSIVE way(taxid, node, rank, up, d) AS (
      SELECT taxid, taxid, rank, parent, 0 FROM _nodes UNION ALL
      SELECT w.taxid, n.taxid, n.rank, n.parent, w.d + 1 FROM way w JOIN _nodes n ON n.taxid = w.up WHERE w.d < {depth - 1})
      SELECT taxid, {picks} FROM way GROUP BY taxid""")


def accession_dictionary(rows: DataFrame, present: DataFrame | None = None) -> DataFrame:
    """(accession, taxid): the last row of each accession by file and ordinal, of those in `present` if it is given."""
    if present is not None:
        rows = rows.join(present.select("accession").distinct(), "accession", "left_semi")
    return rows.groupBy("accession").agg(F.max_by("taxid", F.struct("file", "ordinal")).alias("taxid"))
