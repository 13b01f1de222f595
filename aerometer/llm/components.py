"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerometer.llm.common import written


def _with_min(pairs: DataFrame) -> DataFrame:
    """pairs (u, v) with m, the least of u and all its v. Grouped and joined, so a hub is never gathered."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    return pairs.join(least, "u").select("u", "v", F.least("u", "least").alias("m"))


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of links (u, v); root is the least node reachable.

    Alternating star rounds: each node first hands its larger neighbours to its least one, then its
    smaller neighbours; the tree height falls with every round, so rounds grow with the logarithm of
    the longest chain. Each round is a written table and what is compared is two numbers. Self links
    keep lone nodes; null ends are dropped; no links give no rows.
    """
    ends = links.select(F.col("u").alias("u"), F.col("v").alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    nodes = written(ends.select(F.explode(F.array("u", "v")).alias("node")).distinct(), name)
    pairs = written(ends.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    state = None
    while True:
        both = pairs.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("p")).select("p.*")
        large = _with_min(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        met = _with_min(large)
        small = (met.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(met.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        pairs = written(small, name)
        seen = pairs.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if tuple(seen) == state:
            return nodes.join(pairs.withColumnRenamed("u", "node"), "node", "left").select(
                "node", F.coalesce("v", "node").alias("root"))
        state = tuple(seen)
