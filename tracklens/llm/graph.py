"""Connected components of a large graph."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.storage import stored


def _state(stars: DataFrame) -> tuple:
    sums = stars.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")))
    return tuple(sums.first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(v, u): each node of an edge that isn't its component's smallest, with that one.

    Alternates two steps until nothing changes: every node hands its larger neighbours
    to the smallest one, then every node hands its smaller ones. Neighbours are only
    combined by minimum or joined on single keys, so a hub is never one task's group.
    Null nodes and loops are left out.
    """
    stars = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull()).filter("v <> u").distinct()
    stars = stored(stars, "stars")
    before = _state(stars)
    while before[0]:
        both = stars.select(F.col("v").alias("x"), F.col("u").alias("y")).union(
            stars.select(F.col("u").alias("x"), F.col("v").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        wide = both.filter("y > x").join(low, "x").select(
            F.col("y").alias("v"), F.col("m").alias("u")).distinct()
        low = wide.groupBy("v").agg(F.min("u").alias("m"))
        near = wide.join(low, "v").filter("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        stars = stored(near.union(low.select("v", F.col("m").alias("u"))).distinct(), "stars")
        after = _state(stars)
        if after == before:
            break
        before = after
    return stars
