"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in ``links`` (a, b), the component being the smallest
    id that can be reached.

    Alternating stars: every id links its larger neighbours to its smallest one, then its
    smaller ones. This ends, after about a logarithm of rounds, in one star per
    component. Minima are aggregated before any shuffle, and hot ids are split as skewed
    join keys; no list of neighbours is ever built.
    """
    a, b = F.col("a"), F.col("b")
    edges = checkpointed(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct())
    before = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
        larger = both.join(least, "a").where(b > a).select(b.alias("a"), F.col("least").alias("b")).distinct()
        # Here each id is linked to smaller ones only.
        least = larger.groupBy("a").agg(F.min("b").alias("least"))
        smaller = larger.join(least, "a").select(F.explode(F.array(
            F.struct(b.alias("a"), F.col("least").alias("b")), F.struct(a, F.col("least").alias("b")))).alias("e"))
        edges = checkpointed(smaller.select("e.a", "e.b").where(a != b).distinct())
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    roots = edges.select(b.alias("id"), b.alias("component")).distinct()
    return edges.select(a.alias("id"), b.alias("component")).union(roots)
