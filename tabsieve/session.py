"""Spark session construction and lineage checkpointing."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              driver_memory: str | None = None, app_name: str = "tabsieve") -> SparkSession:
    """Session with AQE (coalesce + skew join) on and the UI off.  Master,
    shuffle partitions and memory are the submitting side's unless given."""
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.master": master,
        "spark.sql.shuffle.partitions": shuffle_partitions and str(shuffle_partitions),
        "spark.driver.memory": driver_memory,
    }
    builder = SparkSession.builder.appName(app_name)
    for k, v in conf.items():
        if v is not None:
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir``.  Only a local
    master, whose executors share the driver's disk, may go without: it gets a
    fresh scratch folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="tabsieve-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` dealt out by ``cols`` over all shuffle partitions: for rows that are
    few bytes but much work each, which AQE would gather into a few tasks."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *cols)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint directory
    and read it back: one job (an RDD checkpoint recomputes its plan unless
    cached), columnar storage, and row/size statistics for AQE's join choice.
    The files live on the cluster's shared storage, so losing an executor
    later does not lose them (never ``localCheckpoint``)."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/tabsieve-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
