"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back, which cuts their lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _star(neighbours: DataFrame, large: bool) -> DataFrame:
    """Link each node's neighbours to the least of them and the node.

    The minimum is a plain aggregate and the neighbours are joined to it, so a
    node with very many of them is summed before the shuffle and split in the join.
    """
    least = neighbours.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = neighbours.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).where("u <> v")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """``node, root`` of every node that has an edge; the root is the least node reachable.

    Each round is written to the shared folder. The number of rounds grows with the
    logarithm of the longest path.
    """
    links = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges"
    )
    before = None
    for _ in range(most_rounds):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, large=True).distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v")
        links = stored(_star(down, large=False).distinct(), "edges")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
