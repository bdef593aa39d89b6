"""Registered queries of the training-data operators: name -> (query, SQL twin or None).

Each query applies its operator to a whole table with production parameters;
the operators themselves live in the sibling modules and take any table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from . import (balltree, chat, debruijn, decontam, linechunks, mixing, quality, resample, runindex, simhash,
               tokencount, tokenfile, urlfilter)
from .common import read


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder in the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def token_files(spark: SparkSession, docs: DataFrame) -> DataFrame:
    path = scratch(spark, "tokens")
    tokenfile.write(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return tokenfile.read_back(spark, path)


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-ID files of all documents, read back."""
    return token_files(spark, read(spark, sf_dir, "documents"))


def op1_chat_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    return chat.collapse(read(spark, sf_dir, "conversations"))


def op2_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items."""
    return decontam.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op3_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines removed of every document as parts of repeated content-defined chunks."""
    return linechunks.report(read(spark, sf_dir, "documents"))


def op4_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: 3-word shingles, 3 bits."""
    return simhash.groups(read(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents in the byte-level vocabulary."""
    return tokencount.token_counts(read(spark, sf_dir, "documents"),
                                   public_tokenizers.path("byte_bpe_50k.json"))


def op6_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of each document."""
    return mixing.report(read(spark, sf_dir, "documents"))


def op7_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL."""
    return urlfilter.judge(read(spark, sf_dir, "pages"))


def op8_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes removed of every document as parts of earlier 100-byte strings."""
    return runindex.report(read(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of the decision list learned from ``labels``."""
    docs = read(spark, sf_dir, "documents")
    return quality.judge(docs, quality.learn(docs, read(spark, sf_dir, "labels")))


def op11_prefix_crc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and draw of every document towards the benchmark's distribution."""
    return resample.resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return balltree.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")) \
        .select("item_id", "rank", "doc_id", "score")


def op13_de_bruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed of every document as parts of 50-word windows of an earlier one."""
    return debruijn.report(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_chat_collapse": (op1_chat_collapse, chat.SQL),
    "op2_string_tiling": (op2_string_tiling, None),
    "op3_line_chunks": (op3_line_chunks, None),
    "op4_golay_simhash": (op4_golay_simhash, None),
    "op5_token_counts": (op5_token_counts, None),
    "op7_url_ratio": (op7_url_ratio, None),  # the models are learned
    "op8_run_index": (op8_run_index, None),
    "op9_quality_rules": (op9_quality_rules, None),  # the list is learned
    "op6_pareto_mix": (op6_pareto_mix, mixing.SQL),
    "op10_token_files": (op10_token_files, None),
    "op11_prefix_crc": (op11_prefix_crc, resample.SQL),
    "op12_ball_tree": (op12_ball_tree, balltree.SQL),
    "op13_de_bruijn": (op13_de_bruijn, debruijn.SQL),
}
