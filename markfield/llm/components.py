"""Connected components of a table of links, by alternating large and small stars.

Each round is two grouped minima and two joins; rounds grow with the logarithm of a component's size, not
with the length of its chains. Links stay in tables of the shared folder. A node of many links is combined
before the shuffle in the minima and split by adaptive skew joins in the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from markfield.llm.common import release, scratch


def components(links: DataFrame, most_rounds: int = 100) -> DataFrame:
    """``node, root`` of every node that has a link in ``a, b``; ``root`` is the least node reachable."""
    spark = links.sparkSession
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    held, before = None, None
    for _ in range(most_rounds):
        path = scratch(spark, "links")
        pairs.write.parquet(path)
        if held:
            release(held)
        held = path
        settled = spark.read.parquet(path)
        now = settled.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before or not now[0]:
            return settled.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before, pairs = now, _small_star(_large_star(settled))
    raise RuntimeError(f"links did not settle within {most_rounds} rounds")


def _large_star(pairs: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of its neighbourhood."""
    both = pairs.select("a", "b").union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = pairs.groupBy("a").agg(F.min("b").alias("least"))
    turned = pairs.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b")
    return turned.union(least.select("a", F.col("least").alias("b"))).distinct()
