"""Connected components of a graph given as a table of edges.

Alternating large-star and small-star steps: every step replaces a vertex's
links by links to the least vertex near it, so a component of any shape becomes
a star around its least vertex within a logarithmic number of rounds.  Each
step is a minimum by key, which is pre-aggregated, and a join back on the key,
whose hot side adaptive execution splits; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from poolspark.plans.shared import materialize


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger vertex ``a`` to the smaller ``b``."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root) of each vertex of ``edges`` (a, b: long); root is the component's least vertex."""
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, mark = materialize(now, "edges"), None
    while True:
        now = materialize(_small(_large(now)), "edges")
        seen = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.select(F.col("a").alias("vertex"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("vertex"), F.col("b").alias("root")).distinct())
