"""Connected components of an edge table by alternating large-star and small-star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hirelake.llm.common import written


def components(edges: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """(node, root): root is the least node that is reachable.

    Each step moves every link to the least neighbour; when a pass changes
    nothing, every node is linked to its root alone.  Only minima are
    aggregated (never lists of neighbours), so a node with many links is
    pre-aggregated like any other key.  Every pass is written to the shared
    folder.  Self-links only make the node known.
    """
    nodes = edges.select(F.explode(F.array(a, b)).alias("node")).distinct()
    links = (edges.where(F.col(a) != F.col(b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    links = written(links, "links")
    state = _state(links)
    for _ in range(most):
        if not state[0]:
            break
        # large star: every larger neighbour is linked to the least neighbour (or the node itself)
        both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u != v").distinct())
        # small star: a node and its smaller neighbours are linked to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        links = written(small, "links")
        now = _state(links)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {most} passes")
    roots = links.groupBy("u").agg(F.min("v").alias("root"))
    return (nodes.join(roots, nodes.node == roots.u, "left")
            .select("node", F.coalesce("root", "node").alias("root")))


def _state(links: DataFrame) -> tuple:
    h = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(h)).first())
