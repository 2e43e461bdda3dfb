"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _checked(df: DataFrame) -> tuple:
    r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: for each node of an edge, the smallest node that it reaches.

    Each round writes its edges to the shared scratch folder. Minima are aggregated before
    the shuffle and written before they are joined back, so that a hot centre's edges can be
    split between tasks. Self-loops and repeated edges are allowed; null ends are ignored.
    """
    spark = edges.sparkSession
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    e = materialize(spark, e, "cc-edges")
    state = _checked(e)
    while state[0]:
        # Large star: every larger neighbour of u moves to the smallest of u and its neighbours.
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(spark, both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(spark, large, "cc-large")
        # Small star: u and its smaller neighbours move to the smallest of them.
        low = materialize(spark, large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        moved = large.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(spark, moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc-small")
        new = _checked(e)
        if new == state:
            break
        state = new
    roots = e.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
