"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs to ``(node, root)``, root the smallest node of its component.

    Loops, repeated and null-ended edges are ignored; a node without another
    neighbour has no row. Edges stay distributed: each round joins them with
    the smallest neighbour of each node (partially aggregated before the
    shuffle, so a star with a huge centre is one row) and is cut by a
    checkpoint. No edges give no rows.
    """
    e = cut(
        edges.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    seen = _signature(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where(F.col("v") > F.col("u"))
            .join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        e = cut(small)
        now = _signature(e)
        if now == seen:
            break
        seen = now
    roots = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
