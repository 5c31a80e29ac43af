"""Connected components of a table of links, without any node's links meeting in one task."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenolith.session import write_once


def follow(parent: DataFrame) -> DataFrame:
    """Follow the pointers ``node -> root``, one of each node and without a cycle, to their ends, doubling the reach each time."""
    while True:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        longer = write_once(parent.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")), "pointers")
        parent = longer.select("node", "root")
        if longer.where("moved").isEmpty():
            return parent


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node that isn't the smallest of its component; ``links`` has the columns ``a`` and ``b``.

    Every node hooks to its smallest neighbour below it, pointers are followed to their roots, links are drawn between roots
    instead, and the rounds go on until none is left. Minima leave each task as one row per node and large keys only meet in
    joins, which may be split. Links of a node with itself say nothing; repeated ones count once; no links give an empty table.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
    edges, parent = write_once(ordered, "links"), None
    while True:
        hooked = follow(write_once(edges.groupBy("node").agg(F.min("root").alias("root")), "hooks"))
        if parent is None:
            parent = hooked
        else:
            next_up = hooked.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            old = parent.join(next_up, "root", "left").select("node", F.coalesce("higher", "root").alias("root"))
            parent = write_once(old.unionByName(hooked), "pointers")
        a = hooked.select("node", F.col("root").alias("a"))
        b = hooked.select(F.col("node").alias("root"), F.col("root").alias("b"))
        moved = edges.join(a, "node", "left").join(b, "root", "left").select(F.coalesce("a", "node").alias("a"), F.coalesce("b", "root").alias("b"))
        ordered = moved.where("a <> b").select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct()
        edges = write_once(ordered, "links")
        if edges.isEmpty():
            return parent
