"""Connected components of narrow edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def connected(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``a, b``); ``root`` is its component's least.

    Alternating star steps: every node is linked to the least of its neighbours, first by its larger
    and then by its smaller ones. Each round is stored in the shared folder. A hub's neighbours are
    reduced to a minimum before the shuffle, and the join that hands it out is split by adaptive
    execution.
    """
    edges = materialize(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    state = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        # large star: neighbours above a node go to its least
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        # small star: a node and its neighbours below go to its least
        large = large.filter("a <> b").distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        edges = materialize(small.select("e.a", "e.b").filter("a <> b").distinct(), "edges")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
