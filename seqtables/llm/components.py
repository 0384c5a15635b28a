"""Connected components of a table of links, by alternating star operations.

Each round points every node's larger neighbours to its least one, then every node and its smaller neighbours to the
least of them; stars of depth one remain, in a number of rounds logarithmic in the longest path. Every round is
joins and partial aggregates whose result is written to the shared folder, so nothing gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqtables.llm.common import Workspace


def components(links: DataFrame, a: str = "a", b: str = "b", work: Workspace | None = None) -> DataFrame:
    """node, component: the least node it is linked with, for every node of the links. Only the last round's table stays."""
    work = work or Workspace(links.sparkSession, "components")
    name = work.number("links")
    edges = work.save(name, links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        nxt = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        done, name = name, work.number("links")
        edges = work.save(name, nxt.filter("u <> v").distinct())
        work.remove(done)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    leaves = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(leaves.select(F.col("component").alias("node"), "component").distinct())
