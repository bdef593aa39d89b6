"""Connected components by alternating large-star and small-star steps.

Every step is an aggregate (map-side combined) and an equi join on the node, so
a hub's edges are pre-aggregated and its join side can be split; each round's
edges are written to the shared checkpoint folder, which also cuts the lineage.
Rounds are about the logarithm of the longest path.  Only a count and a
checksum of the edges reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

MAX_ROUNDS = 50


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """``edges`` (u, v): all neighbours v of u (``small``: only those below u)
    get linked to the least of u and its neighbours (``small``: u as well;
    else only the neighbours above u)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if small:
        moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
    return edges.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, v) links between orderable ids -> (node, root): the least id of the
    component of every node that has a link.  Direction, repeats and loops of
    the links do not matter; NULL ends are no links; no links give no rows."""
    u, v = edges.columns
    now = cut_lineage(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                      .filter(F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col("u") != F.col("v"))).distinct())

    def mark(df: DataFrame) -> tuple:
        r = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        return r.n, r.h

    seen = mark(now)
    for _ in range(MAX_ROUNDS if seen[0] else 0):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        now = cut_lineage(_star(_star(both, small=False), small=True))
        before, seen = seen, mark(now)
        if seen == before:
            break
    else:
        if seen[0]:
            raise RuntimeError(f"components: not settled after {MAX_ROUNDS} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
