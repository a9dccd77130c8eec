"""Connected components of an edge table, by alternating stars.

``connected_components(edges)`` takes ``(a, b)`` pairs of long ids and returns
``(id, component)`` for every id in an edge, ``component`` being the smallest
id reachable. Each round is two aggregates and two joins over the edges
(large star, then small star); the edge set is written under the checkpoint
folder after each round, so lineage stays short and a lost executor does not
replay the rounds. Only a row count and a checksum reach the driver.

Null ids and self-loops are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import materialize


def _signature(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.shiftright(F.xxhash64("u", "v"), 20)), F.lit(0))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    e = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where(a.isNotNull() & b.isNotNull() & (F.col("u") != F.col("v"))).distinct(), "edges")
    seen = _signature(e)
    for _ in range(max_rounds if seen[0] else 0):
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        now = _signature(e)
        if now == seen:
            break
        seen = now
    else:
        if seen[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    out = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return out.union(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
