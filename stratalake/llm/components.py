"""Connected components of a link table, by rounds of joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import written


def connected_components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node of ``links`` (x, y: bigint); component is the smallest node reached.

    Alternates two steps until nothing changes: every node hands its smallest neighbour to its larger
    neighbours, then to its smaller ones. The links in turn become stars around the smallest nodes, in
    about log(nodes) rounds. A node with very many links is reduced on the map side in the aggregation,
    and the join back to its links is one that adaptive execution splits.
    """
    edges = written(
        links.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "links"
    )
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u")
        edges = written(
            smaller.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(smaller.select("u", "m"))
            .where("u <> v")
            .distinct(),
            "links",
        )
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before:
            stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return stars.union(edges.select("v", "v")).distinct()
        before = state
    raise RuntimeError("the components did not settle")
