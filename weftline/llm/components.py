"""Connected components over a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm.common import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One round: every node's neighbours on one side are tied to the least node among them and itself.

    ``large`` ties the neighbours above a node, looking at both directions; otherwise the
    neighbours below.  The minimum is aggregated before the shuffle and joined back, so a
    hub's rows can be split by the skew join.
    """
    if large:
        sided = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        sided = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = sided.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = sided.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """``(node, root)`` for every node of an edge; root is the least node of its component.

    Alternating large and small stars: the edges of a component become a star around its
    least node after a number of rounds logarithmic in its size.  Each round is written to
    the checkpoint folder; only an edge count and checksum reach the driver.  Self-loops,
    repeated and null edges are allowed (null ends are left out).
    """
    now = checkpointed(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u <> v").distinct())
    seen = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            break
        seen = tuple(state)
        now = checkpointed(_star(_star(now, True), False))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
