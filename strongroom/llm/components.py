"""Connected components of a table of links, as Spark joins and aggregates.

Alternates two steps until nothing changes: every node links its larger
neighbours to the smallest node it sees, then its smaller neighbours and
itself.  What is left is a star for each component, its smallest node in the
middle.  A node's smallest neighbour is a partially aggregated minimum joined
back, so a node with very many links is never gathered into one group, and
nothing but a count comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strongroom.llm.common import stored


def to_smallest(links: DataFrame, larger: bool) -> DataFrame:
    """One step over links (u, v) with u > v; gives such links again."""
    if larger:  # both directions, so every node sees all its neighbours
        seen = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = links.select("u", "v")
    # Stored, so both sides of the join are plain shuffles and Spark can split those of a node with very many links.
    least = stored(seen.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("n"), F.least("u", "m").alias("m")), "least")
    joined = seen.join(least, F.col("u") == F.col("n"))
    if larger:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(joined.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """(node, component) for every node with a link to another; the component
    is its smallest node.  Links with a null end and loops count for nothing."""
    node = links.schema[a].dataType
    pairs = links.select(F.col(a).cast(node).alias("x"), F.col(b).cast(node).alias("y")).where("x <> y")
    links = stored(pairs.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "links")
    mark = lambda df: df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    before = mark(links)
    for _ in range(rounds):
        if not before[0]:
            break
        links = stored(to_smallest(stored(to_smallest(links, True), "links"), False), "links")
        now = mark(links)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
