"""SimHash near-duplicates by Golay-code fuzzy hashing.

**Fingerprint.**  64 bits; a bit is 1 if it is set in over half of the XXH64
hashes (seed 42) of the text's shingles of ``shingle`` words (lower-cased A-Z,
repeats counted, joined by one space; fewer words: the whole sequence as one
shingle; no word: fingerprint zero).

**Fuzzy keys.**  The perfect binary Golay code decodes every 23-bit word to the
one codeword within 3 bits, so a word has 12-bit codeword indices as keys: its
own decoding, and the decodings of the words one bit away (1 or 6 different
ones).  If y is at most one bit from x, y's own index is among x's keys.  A
fingerprint is cut into segments of 22, 21 and 21 bits (zero-padded to 23).
With at most 3 differing bits in total, two of the three segments differ by at
most one bit each (pigeonhole), so for one of the three segment pairs y's pair
of own indices (24 bits) is among x's pairs of keys: an equi join finds every
link, and the exact distance is verified afterwards.

**Scale.**  Equal fingerprints collapse before the join (map-side combine), so
copies cost nothing.  See :func:`links` for crowded buckets and
:mod:`components` for the classes.  Nothing is collected.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import written
from .components import components

SHINGLE, MAX_BITS, SEED = 3, 3, 42
GOLAY = 0b110001110101  # fixed value: a generator polynomial of the [23, 12] Golay code
SEGMENTS = ((0, 22), (22, 21), (43, 21))
PAIRS = ((0, 1), (0, 2), (1, 2))
SLICE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit fingerprint of one text."""
    w = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII letters and spaces only
    if not w:
        return 0
    k = min(shingle, len(w))
    grams = map(b" ".join, zip(*(islice(w, i, None) for i in range(k))))
    hashes = map(xxhash.xxh64_intdigest, grams, repeat(SEED))
    n, ones = len(w) - k + 1, np.zeros(64, np.int64)
    for i in range(0, n, SLICE):
        h = np.fromiter(islice(hashes, SLICE), "<u8", min(SLICE, n - i))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp as signed long) per document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b["text"]], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return rows.mapInArrow(compute, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


class Golay:
    """Decoding of 23-bit words to 12-bit codeword indices, for numpy arrays."""

    def __init__(self):
        x = np.arange(1 << 12, dtype=np.uint32) << 11
        for bit in range(22, 10, -1):  # remainders of the high 12 bits by long division
            x = np.where(x >> bit & 1, x ^ (GOLAY << (bit - 11)), x)
        self.rest = x
        bits = 1 << np.arange(23, dtype=np.uint32)
        self.leader = np.zeros(1 << 11, np.uint32)  # the error of weight 3 at most behind every remainder
        errors = np.array([0], np.uint32)
        for _ in range(3):
            errors = np.unique(errors[:, None] | np.append(bits, 0).astype(np.uint32))
        self.leader[self.remainder(errors)] = errors

    def remainder(self, x: np.ndarray) -> np.ndarray:
        return self.rest[x >> 11] ^ (x & 0x7FF)

    def index(self, x: np.ndarray) -> np.ndarray:
        return (x ^ self.leader[self.remainder(x)]) >> 11

    def near(self, x: np.ndarray, width: int) -> np.ndarray:
        """(n, width + 1) indices of x and of the words one of ``width`` bits
        away; repeats in a row are -1."""
        flips = np.concatenate([[0], 1 << np.arange(width)]).astype(np.uint32)
        found = np.sort(self.index(x[:, None] ^ flips).astype(np.int64), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        return found


def own_keys(fp: np.ndarray, golay: Golay) -> np.ndarray:
    """(n, 3) keys: one per pair of segments, from the segments' own decodings."""
    parts = [golay.index((fp >> np.uint64(a) & np.uint64((1 << w) - 1)).astype(np.uint32)).astype(np.int64)
             for a, w in SEGMENTS]
    return np.stack([(p << 24) | (parts[i] << 12) | parts[j] for p, (i, j) in enumerate(PAIRS)], axis=1)


def near_keys(fp: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key by which a link of the row may be found."""
    parts = [golay.near((fp >> np.uint64(a) & np.uint64((1 << w) - 1)).astype(np.uint32), w) for a, w in SEGMENTS]
    short = []
    for p in parts:  # 1 or 6 indices each: squeeze the row's blanks out
        p = -np.sort(-p, axis=1)
        short.append(p[:, :(p >= 0).sum(1).max(initial=1)])
    rows, keys = [], []
    for p, (i, j) in enumerate(PAIRS):
        a, b = short[i][:, :, None], short[j][:, None, :]
        ok = (a >= 0) & (b >= 0)
        rows.append(np.nonzero(ok)[0])
        keys.append(((p << 24) | (a << 12) | b)[ok])
    return np.concatenate(rows), np.concatenate(keys)


def links(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(x, y) with x < y: the pairs of different fingerprints in ``prints``
    (column fp) at ``max_bits`` (3 at most) or fewer differing bits.

    The probing side carries about 85 keys a fingerprint, the probed one 3.
    A crowded bucket is an equi-join key whose side Spark splits and streams;
    pairs are verified inside the join, so only links leave it."""
    if not 0 <= max_bits <= 3:
        raise ValueError("two of three segments within one bit each hold for 3 differing bits at most")
    distinct = prints.select("fp").filter("fp IS NOT NULL").distinct()

    def keyed(near: bool, out: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            golay = Golay()
            for b in batches:
                every = np.asarray(b["fp"]).view(np.uint64)
                for at in range(0, len(every), 1 << 12):
                    fp = every[at:at + (1 << 12)]
                    rows, keys = near_keys(fp, golay) if near else (
                        np.repeat(np.arange(len(fp)), 3), own_keys(fp, golay).ravel())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys.astype(np.int64)), pa.array(fp[rows].view(np.int64))], ["key", out])
        return distinct.mapInArrow(run, f"key long, {out} long")

    found = keyed(True, "x").join(keyed(False, "y"), "key") \
        .filter((F.col("x") != F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits))
    return found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (least doc_id linked,
    directly or through others, itself included), n_links (other fingerprints
    within ``max_bits``) and n_copies (rows with the same fingerprint).

    Defined cases: NULL, empty and blank texts have fingerprint zero and link
    like any other; a NULL id is a document whose id never is a component's,
    unless all of the component's are NULL; repeated rows give one row each;
    an empty table gives no rows; other columns are ignored."""
    prints = cut_lineage(fingerprints(docs, shingle, id_col, text_col))
    same = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n_copies"))
    pairs = cut_lineage(links(prints, max_bits))
    degree = pairs.select("x").unionAll(pairs.select("y")).groupBy(F.col("x").alias("fp")).agg(
        F.count("*").alias("n_links"))
    roots = components(pairs).withColumnRenamed("node", "fp").join(degree, "fp")
    linked = cut_lineage(roots.join(same, "fp"))
    # written as well: both sides of the join are dealt anew, and a large component's side can be split
    least = cut_lineage(linked.groupBy("root").agg(F.min("least").alias("component_id")))
    linked = linked.join(least, "root") \
        .select("fp", "component_id", "n_links")
    known = cut_lineage(same.join(linked, "fp", "left").select(
        "fp", "n_copies", F.when(F.col("n_links").isNull(), F.col("least")).otherwise(F.col("component_id"))
        .alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    return prints.join(known, "fp").select("doc_id", hex_digits(F.col("fp")).alias("fingerprint"),
                                           "component_id", "n_links", "n_copies")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row of each group, the columns as they are: the one of the least id,
    then of the least hash of the text, then any of the rows equal in both.
    Rows without id come last and are rows like any other."""
    # written, so that a row has the same number whenever it is read
    rows = written(docs.withColumn("__no", F.monotonically_increasing_id()))
    place = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                     F.xxhash64(text_col).alias("row"), F.col("__no").alias("no"))
    kept = groups(rows.select(place.alias("__place"), F.col(text_col).alias("text")), id_col="__place", **kw) \
        .filter("doc_id = component_id").select(F.col("doc_id.no").alias("__kept"))
    return rows.join(kept, F.col("__no") == F.col("__kept"), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
