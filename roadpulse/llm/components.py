"""Connected components of a graph that is larger than one machine."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.tables import kept, settle

MOST_ROUNDS = 60


def _nearest(edges: DataFrame) -> DataFrame:
    """For each edge (u, v) the least of u and its neighbours. Minima combine before the shuffle, so a hub is no burden."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component, its least node, for every node that has an edge.

    Alternates two steps until nothing changes: all larger neighbours of a node are tied to its least
    neighbour, then all smaller ones are. Each step keeps the components; the number of rounds grows
    with the logarithm of their size. Each round is a written table that takes the place of the one before.
    """
    settle(edges.sparkSession)
    one = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u is not null and v is not null and u <> v")
    now, place = kept(one.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = None
    for _ in range(MOST_ROUNDS):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _nearest(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = _nearest(large)
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(near.select("u", F.col("m").alias("v")))
        now, place = kept(small.filter("u <> v").distinct(), "edges", instead_of=place)
        after = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if after == state:
            break
        state = after
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
