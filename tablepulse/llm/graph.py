"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablepulse.session import checkpointed


def _to_least(pairs: DataFrame) -> DataFrame:
    """Each (a, b) with ``m``, the least of a and all its b. The minima are written out, so that both
    sides of the join are plain exchanges and a node with very many neighbours can be split."""
    least = checkpointed(pairs.groupBy("a").agg(F.min("b").alias("m")))
    return pairs.join(least, "a").withColumn("m", F.least("a", "m"))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its least node) of every node in ``edges`` (a, b: integers).

    Rows are edges all the way: no node's neighbours are ever gathered. Takes about log(n)**2 rounds at
    most, for chains too; each round is written to the checkpoint folder.
    """
    edges = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    nodes = edges
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _to_least(both).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # every pair now points to a smaller node; the small star hangs them under the least of them
        down = _to_least(checkpointed(large))
        small = down.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(down.select("a", F.col("m").alias("b")))
        edges = checkpointed(small.distinct())
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = nodes.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(found, "node", "left_anti")
    return found.unionByName(roots.select("node", F.col("node").alias("component")))
