"""Reading the benchmark tables and the role each plays (see README, bindings).

movie + label   orders, y = (o_orderstatus = 'F')
folds / split   fold = o_orderkey % 5, train = o_orderkey % 10 < 8
crew bridges    lineitem (l_orderkey, l_suppkey) and (l_orderkey, l_partkey)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c: Column | str, name: str | None = None) -> Column:
    """Round doubles to 6 places for engine-independent comparison."""
    col = F.col(c) if isinstance(c, str) else c
    out = F.round(col.cast("double"), 6)
    return out.alias(name or (c if isinstance(c, str) else "value"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, y, fold, is_train) — the labelled entity table."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"),
        (F.col("o_orderkey") % 5).alias("fold"),
        (F.col("o_orderkey") % 10 < 8).alias("is_train"))


def supplier_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")


def part_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
