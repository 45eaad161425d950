"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from targetlens.llm.common import Scratch


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
    ).first()
    return row["n"], row["s"]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row per node of ``edges``: ``node`` and ``component``, the smallest node it reaches.

    Every step replaces a node's links by links to its smallest neighbour: minima combine before
    the shuffle, no group is gathered, and the number of links never grows. Only two numbers per
    round reach the driver. NULL ends and loops are ignored; an edge list without rows gives none.
    """
    scratch = Scratch(edges.sparkSession)
    links = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    ).distinct()
    links = scratch.keep(links)
    before = _checksum(links)
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.join(nearest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(
            F.explode(F.array(
                F.struct(F.col("u"), F.col("m").alias("v")),
                F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            )).alias("e")
        ).select("e.u", "e.v").where("u != v").distinct()
        links = scratch.keep(small)
        scratch.drop(keep_last=1)
        after = _checksum(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
