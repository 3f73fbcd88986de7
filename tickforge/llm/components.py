"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.llm import scratch as S

#: Parts of a node's neighbours.
SALTS = 64


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Each node's neighbours (larger ones, or smaller ones and itself) are tied to its smallest neighbour."""
    if large:
        near = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # a node's neighbours are met in SALTS parts, so that a large star is no hot key
    near = near.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    parts = near.groupBy("u", "salt").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.least(F.min("m"), F.col("u")).alias("m"))
    tied = near.join(parts.select("u", "salt").join(least, "u"), ["u", "salt"])
    out = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")) if large else tied.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.where("u != v").distinct()


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(u, component) for every node of links (a, b): the smallest node that it reaches.  Nodes must not be null."""
    pairs = S.settle(spark, links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), "links")
    mark = None
    while True:
        pairs = S.settle(spark, _star(_star(pairs, True), False), "stars")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == now:
            break
        mark = now
    roots = pairs.select(F.col("v").alias("u")).distinct()
    return pairs.select("u", F.col("v").alias("component")).unionByName(roots.select("u", F.col("u").alias("component")))
