"""Spark-side helpers shared by the operators of this folder."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlake.session import checkpoint_base, shared_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Lets Python workers import this package."""
    ship_package(spark)


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read again: several
    readers share one computation, and a lost executor loses none of it."""
    spark = df.sparkSession
    checkpoint_base(spark)
    path = shared_dir(spark, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_size(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0]


def blocks_for(size: int, each: int, least: int = 12) -> int:
    """How many blocks of about ``each`` hold ``size``."""
    return max(least, math.ceil(size / each))


def connected(links: DataFrame) -> DataFrame:
    """Components of an undirected graph of 64-bit nodes.

    ``links(a, b)`` -> ``(node, component)`` for every node of a link, where
    component is the smallest node reached (signed order).  Alternates two
    steps until nothing changes: every node hands its larger neighbours to its
    smallest one, then its smaller ones.  Each step is an aggregate (combined
    before its shuffle) and an equi-join whose other side has one row a node, so
    a node with very many links is split by AQE's skew join.  Rounds are written
    below ``spark.checkpoint.dir``."""
    edges = stored(links.where("a <> b")
                   .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def state(e):
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = state(edges)
    while now[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = (small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = stored(small, "links")
        before, now = now, state(edges)
        if before == now:
            break
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
