"""A corpus pipeline from the training-data operators.

Every stage takes (spark, docs, sf_dir), works on all documents that its
predecessor kept and returns the ones it keeps, with the columns of
``documents``; the last writes the token files and returns their index.
Learned rules and word-level tiling are beyond SQL, so there is no twin; the
tests hold every stage against a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tabsieve.llm import decontam, mixing, quality, simhash
from tabsieve.llm import queries as q
from tabsieve.llm.common import read
from tabsieve.session import ensure_checkpoint_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned decision list keep."""
    return quality.keep(docs, quality.learn(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the least id, of each near-duplicate group."""
    return simhash.keep_one(docs, shingle=3, max_bits=3)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"), keep_null=False)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice is there twice."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: one row per document taken."""
    return q.token_files(spark, docs)


STAGES = [("quality rules", quality_rules), ("near dedup", near_dedup), ("decontamination", decontaminate),
          ("mixing", mix_sources), ("token output", token_output)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written to the
    shared folder and read again by the next one."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            out.write.parquet(f"{base}/{k}")
            out = spark.read.schema(out.schema).parquet(f"{base}/{k}")
        docs = out
    return docs
