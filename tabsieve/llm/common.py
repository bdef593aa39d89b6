"""Shared pieces of the training-data operators: word rules and table reads."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SPACES = " \t\n\x0b\x0c\r"  # \x20 and \x09-\x0D, the only word separators
SPACE_RUN = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a zstandard-compressed Parquet table in the shared checkpoint
    folder: for wide intermediate rows, of which disk is the scarce part."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row (a one-element
    array binds it to a lambda variable, so it is not copied into every use)."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the maximal runs of non-separators; NULL and blank give an empty array."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")) \
        .otherwise(F.split(bare, SPACE_RUN))


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """``df`` reduced to the columns named by the values, called by the keys;
    found by position, so that other columns, also ones whose names differ in
    case only, do not matter.  An exact name goes before one that fits otherwise."""
    names = df.columns
    at = {k: names.index(c) if c in names else [n.lower() for n in names].index(c.lower()) for k, c in cols.items()}
    return df.toDF(*[f"c{i}" for i in range(len(names))]).select(*[F.col(f"c{i}").alias(k) for k, i in at.items()])


# lower-cases A-Z; every other ASCII byte but 0-9 and a-z becomes a space
FOLDED = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def pieces(data: bytes, size: int = PIECE) -> Iterator[bytes]:
    """``data`` cut at white space into pieces of about ``size`` bytes, so that a
    long text's words are never all in one list."""
    at = 0
    while len(data) - at > size:
        cut = _SPACE.search(data, at + size)
        if cut is None:
            break
        yield data[at:cut.start()]
        at = cut.end()
    yield data[at:] if at else data


def folded_words(text: str | None) -> Iterator[list[bytes]]:
    """The words (maximal runs of 0-9, A-Z, a-z and other than ASCII) of a
    text, A-Z lower-cased, in lists of bounded size."""
    for piece in pieces((text or "").encode("utf-8", "replace").translate(FOLDED)):
        yield piece.split()
