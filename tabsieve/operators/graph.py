"""Ranking of people and titles by a damped random walk on their credits.

``pagerank`` is general: a weighted directed graph, extra nodes without edges,
dangling mass spread evenly.  ``credit_ranks`` walks a bridge table both ways,
title to person and back, so people in common titles and titles of common
people rise together; no pair of people is ever formed.

Scale: edges are dealt out once, into a table bucketed by their source, and
every round joins them in place; only the ranks (one row a node) and the sums
per target, combined map-side, are shuffled.  A source with more than
``SPLIT`` edges is salted over several buckets, its rank row repeated for each.
Each round's ranks are written to the shared checkpoint folder, which cuts the
lineage; of a round only the summed change and the dangling mass reach the
driver.  The tables stay until the checkpoint folder is cleared.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, ensure_checkpoint_dir

SPLIT = 1 << 20  # edges of one source in one bucket
# Spark takes a bucket of one file as sorted only with this: else every round sorts the edges again
BUCKETS_ORDERED = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def _bucketed(df: DataFrame, *cols: str) -> str:
    """Name of a table of ``df`` whose files, one a bucket, are dealt out and
    sorted by ``cols``: later joins on them read it in place."""
    spark = df.sparkSession
    name = f"edges_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, *cols).write.bucketBy(n, *cols).sortBy(*cols).option(
        "path", f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name)
    return name


def pagerank(edges: DataFrame, nodes: DataFrame | None = None, damping: float = 0.85, rounds: int = 50,
             tol: float = 1e-6, split: int = SPLIT) -> DataFrame:
    """(node, rank, rounds) of a graph of ``edges`` (src, dst, weight) and ``nodes``
    (node): ranks sum to 1, ``rounds`` tells how many were made.  A node passes its rank on in proportion to the
    weights; the rank of nodes without way out is spread over all.  Ends when
    the summed change falls below ``tol``, at the latest after ``rounds``.

    Parallel edges add up; edges with a NULL end or without positive weight, and
    NULL nodes, do not count; an empty graph has no ranks."""
    edges = edges.filter("src is not null and dst is not null and weight > 0") \
        .groupBy("src", "dst").agg(F.sum(F.col("weight").cast("double")).alias("weight"))
    edges = cut_lineage(edges)
    none = F.lit(None).cast("double")
    ends = edges.select(F.col("src").alias("node"), "weight", F.lit(1).alias("way")) \
        .unionByName(edges.select(F.col("dst").alias("node"), none.alias("weight"), F.lit(0).alias("way")))
    if nodes is not None:
        ends = ends.unionByName(nodes.filter("node is not null").select(
            "node", none.alias("weight"), F.lit(0).alias("way")))
    # nodes, their weights and their numbers of ways out from one aggregate; out is NULL without any
    known = cut_lineage(ends.groupBy("node").agg(
        F.sum("weight").alias("out"), F.ceil(F.sum("way") / F.lit(split)).cast("int").alias("salts")))
    n, most = known.agg(F.count("*"), F.max("salts")).first()
    if n == 0:
        return known.select("node", F.lit(0.0).alias("rank"), F.lit(0).alias("rounds"))
    salt = F.lit(0)
    if most > 1:  # a hub's edges go to several buckets
        hubs = known.filter("salts > 1").select(F.col("node").alias("src"), "salts")
        edges = edges.join(hubs, "src", "left")
        salt = F.coalesce(F.pmod(F.xxhash64("dst"), F.col("salts")).cast("int"), F.lit(0))
    salted = edges.select("src", salt.alias("salt"), "dst", "weight")
    name = _bucketed(salted, "src", "salt")
    conf = known.sparkSession.conf
    ordered = conf.get(BUCKETS_ORDERED)
    conf.set(BUCKETS_ORDERED, "true")
    try:
        state, made = _walk(known, known.sparkSession.table(name), n, damping, rounds, tol)
    finally:
        conf.set(BUCKETS_ORDERED, ordered)
        known.sparkSession.sql(f"DROP TABLE {name}")  # its name only: the files lie outside the warehouse
    return state.select("node", "rank", F.lit(made).alias("rounds"))


def _walk(known: DataFrame, edges: DataFrame, n: int, damping: float, rounds: int, tol: float) -> tuple[DataFrame, int]:
    """Rounds from equal ranks: the last ranks and how many rounds were made."""
    state = known.withColumn("rank", F.lit(1.0 / n))
    made = 0
    loose = known.agg(F.count_if(F.col("out").isNull())).first()[0] / n
    for made in range(1, rounds + 1):
        sent = state.filter("out is not null").select(
            F.col("node").alias("src"), (F.col("rank") / F.col("out")).alias("share"),
            F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        got = edges.join(sent.hint("merge"), ["src", "salt"]).groupBy(F.col("dst").alias("node")).agg(
            F.sum(F.col("share") * F.col("weight")).alias("got"))
        rank = F.lit((1 - damping) / n) + F.lit(damping) * (F.coalesce("got", F.lit(0.0)) + F.lit(loose / n))
        state = cut_lineage(state.withColumnRenamed("rank", "old").join(got.hint("shuffle_hash"), "node", "left").select(
            "node", "out", "salts", "old", rank.alias("rank")))
        row = state.agg(F.sum(F.abs(F.col("rank") - F.col("old"))).alias("change"),
                        F.coalesce(F.sum(F.when(F.col("out").isNull(), F.col("rank"))), F.lit(0.0)).alias("loose")).first()
        state, loose = state.drop("old"), row["loose"]
        if row["change"] < tol:
            break
    return state, made


def credit_ranks(bridge: DataFrame, entity: str, person: str, entities: DataFrame | None = None, **how) -> DataFrame:
    """(side 'person' or 'entity', key as string, rank) of the walk over the credits
    ``bridge(entity, person)``, a repeated credit counting again; ``entities`` adds
    those without any credit."""
    both = bridge.select(F.concat(F.lit("e"), F.col(entity).cast("string")).alias("e"),
                         F.concat(F.lit("p"), F.col(person).cast("string")).alias("p"))
    one = both.select(F.col("e").alias("src"), F.col("p").alias("dst"), F.lit(1.0).alias("weight"))
    back = both.select(F.col("p").alias("src"), F.col("e").alias("dst"), F.lit(1.0).alias("weight"))
    nodes = None if entities is None else entities.select(
        F.concat(F.lit("e"), F.col(entity).cast("string")).alias("node"))
    ranks = pagerank(one.unionByName(back), nodes, **how)
    return ranks.select(F.when(F.substring("node", 1, 1) == "e", "entity").otherwise("person").alias("side"),
                        F.expr("substring(node, 2)").alias("key"), "rank")
