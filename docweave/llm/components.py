"""Connected components by alternating large-star and small-star steps.

Each step is an aggregate with map-side combine and a join that streams, so a
node with very many neighbours takes one task time, but no memory.
Lineage is cut after each round; the driver sees two numbers a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docweave.llm.store import discard, written


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")), F.lit(0))).first()
    return int(row[0]), int(row[1])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    joined = edges.join(least, "hi")
    moved = joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    kept = least.select("hi", F.col("m").alias("lo"))
    return moved.unionAll(kept).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge with two ends; root is the smallest node of the component.

    Edges may repeat, point either way or be loops (which are left out, as are
    edges with a null end).  Without edges the result is empty.
    """
    now = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct()
    now = written(now, "components")
    before = _state(now)
    while before[0]:
        after = written(_small_star(_large_star(now)), "components")
        state = _state(after)
        discard(now)
        now = after
        if state == before:
            break
        before = state
    roots = now.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct()
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionAll(roots)
