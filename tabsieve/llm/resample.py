"""Importance resampling towards a target distribution, on prefix CRCs.

Features of a text are its runs of 1 to ``MAX_N`` consecutive words (A-Z
lower-cased, one space between words), each counted in the bucket that the
CRC-32 of its bytes gives.  No run's bytes are ever put together: one scan of
the separator-normalised text stores the running CRC at the end of every word,
and the CRC of any run follows from the two prefixes around it.  Appending L
bytes multiplies the old register by x^(8L) over GF(2), so

    crc(run) = crc(prefix up to its end) xor shift(crc(prefix up to its start), L)

and the running CRC up to a word's start is that of the word before, moved on
by one space.

1. The scan writes a table of running CRCs and word lengths (8 bytes a word).
2. Its runs are counted per bucket in each task; a task's ``BUCKETS`` sums meet
   in an aggregate.  The target's likewise.  The sums, ``BUCKETS`` numbers
   whatever the size, reach the driver and give every bucket's gain.
3. A document's weight is the sum of its runs' gains.  With Gumbel noise from a
   hash of its id it is the document's score; the highest scores are drawn,
   which samples documents without replacement in proportion to exp(weight/1000).
   Ranks are prefix sums in bounded pieces: no task orders all documents.

Defined cases: NULL or wordless texts have no feature and weight 0; a NULL id
hashes like an empty one and goes first among equal scores; rows that share an
id share its noise, and each is ranked by itself; an empty table gives no rows,
an empty target gains from its absence only; other columns do not matter.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import sorted_prefix
from .common import folded_words, pick, written

BUCKETS, MAX_N, MIN_WORDS, SHARE, SEED = 10_000, 3, 20, (5, 100), 42
STEP = 1 << 18  # runs at a time
CRC32 = 0xEDB88320  # fixed value: the reversed polynomial
NEAR = 64  # lengths below have a table of their own


@functools.cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Shifts of each byte of a register by 0..NEAR-1 zero bytes, and by NEAR * 2^k."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, byte >> 1 ^ np.uint32(CRC32), byte >> 1)
    near = [np.arange(256, dtype=np.uint32) << np.arange(0, 32, 8, dtype=np.uint32)[:, None]]
    for _ in range(NEAR):
        near.append(near[-1] >> 8 ^ byte[near[-1] & 255])
    far = [near.pop()]
    for _ in range(40):
        far.append(apply(far[-1], far[-1]))
    return np.array(near), np.array(far)


def apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """One shift (a table of four bytes' values) of every register."""
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def shift(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Registers (uint32) after ``size`` more zero bytes each."""
    near, far = tables()
    low = size % NEAR
    out = near[low, 0, crc & 255] ^ near[low, 1, crc >> 8 & 255] ^ near[low, 2, crc >> 16 & 255] ^ near[low, 3, crc >> 24]
    high, k = size // NEAR, 0
    while high.any():
        some = np.flatnonzero(high & 1)
        out[some] = apply(far[k], out[some])
        high, k = high >> 1, k + 1
    return out


def running(text: str | None) -> tuple[bytes, bytes]:
    """Running CRC-32 at every word's end in the normalised text, and the words' lengths (uint32 each)."""
    crcs, sizes, crc = [], [], None
    for words in folded_words(text):
        if not words:
            continue
        sizes.append(np.fromiter(map(len, words), np.uint32, len(words)))
        if crc is None:
            crc, words = zlib.crc32(words[0]), words[1:]
            crcs.append(np.array([crc], np.uint32))
        if words:
            ends = accumulate(words, lambda c, w: zlib.crc32(b" " + w, c), initial=crc)
            next(ends)
            crcs.append(np.fromiter(ends, np.uint32, len(words)))
            crc = int(crcs[-1][-1])
    return (np.concatenate(crcs).tobytes(), np.concatenate(sizes).tobytes()) if crcs else (b"", b"")


def prefixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, crcs, sizes): the running CRCs of every text, stored."""
    rows = pick(docs, doc_id=id_col, text=text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [running(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array([c for c, _ in found], pa.binary()),
                                              pa.array([s for _, s in found], pa.binary())], ["doc_id", "crcs", "sizes"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return written(rows.mapInArrow(scan, f"doc_id {id_type}, crcs binary, sizes binary"))


def runs(crcs: list[bytes], sizes: list[bytes], max_n: int = MAX_N) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document number, CRC-32) of every run of 1 to ``max_n`` words of some
    documents, a bounded number at a time."""
    ends = np.frombuffer(b"".join(crcs), np.uint32)
    size = np.frombuffer(b"".join(sizes), np.uint32).astype(np.int64)
    counts = np.array([len(c) // 4 for c in crcs], np.int64)
    last = np.cumsum(counts)
    offset = np.concatenate([[0], np.cumsum(size)])
    for a in range(0, len(ends), STEP):
        word = np.arange(a, min(a + STEP, len(ends)))
        doc = np.searchsorted(last, word, "right")
        before = shift(ends[word - 1] ^ np.uint32(0xFFFFFFFF), np.ones(len(word), np.int64))  # a step by a space:
        before = before ^ SPACE_STEP ^ np.uint32(0xFFFFFFFF)  # the shift is linear, the space adds its own value
        before[word == (last - counts)[doc]] = 0
        for n in range(1, max_n + 1):
            some = np.flatnonzero(word + n <= last[doc])
            first = word[some]
            length = offset[first + n] - offset[first] + n - 1
            yield doc[some], ends[first + n - 1] ^ shift(before[some], length)


# what one space adds to a register of zeros
SPACE_STEP = np.uint32(zlib.crc32(b" ", 0xFFFFFFFF) ^ 0xFFFFFFFF)


def counts(table: DataFrame, buckets: int, max_n: int) -> np.ndarray:
    """Runs of a table of prefixes per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, crc in runs(batch["crcs"].to_pylist(), batch["sizes"].to_pylist(), max_n):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["bucket", "n"])

    found = table.select("crcs", "sizes").mapInArrow(count, "bucket int, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # a row per bucket at most
    out = np.zeros(buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Rounded thousandfold log ratio of the smoothed bucket frequencies."""
    b, s_all, t_all = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row of ``docs``; ``target`` has a ``text`` too."""
    table = prefixes(docs, id_col, text_col)
    wanted = prefixes(target.select(F.lit(None).cast("long").alias("doc_id"),
                                    *[F.col(c) for c in target.columns if c == text_col]), "doc_id", text_col)
    gain = gains(counts(table, buckets, max_n), counts(wanted, buckets, max_n))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = batch["crcs"].to_pylist()
            words = np.array([len(c) // 4 for c in crcs], np.int64)
            n, weight = np.zeros(len(crcs), np.int64), np.zeros(len(crcs), np.int64)
            for doc, crc in runs(crcs, batch["sizes"].to_pylist(), max_n):
                if len(doc):
                    at = np.flatnonzero(np.diff(doc, prepend=-1))  # doc is sorted
                    weight[doc[at]] += np.add.reduceat(gain[crc % np.uint32(buckets)], at)
                    n[doc[at]] += np.diff(at, append=len(doc))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(words), pa.array(n), pa.array(weight)],
                                             ["doc_id", "n_words", "n_features", "weight"])

    id_type = table.schema["doc_id"].dataType.simpleString()
    return written(table.mapInArrow(add, f"doc_id {id_type}, n_words long, n_features long, weight long"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank (of the documents drawn, else NULL) per document."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                                  .cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")
    rows = weigh(docs, target, id_col, text_col).withColumn("score", F.col("weight") + noise)
    able = F.col("n_words") >= min_words
    n = rows.filter(able).count() * share[0] // share[1]
    ranked = sorted_prefix(rows.filter(able).withColumn("low", -F.col("score")), [], "low", {"before": F.lit(1)},
                           tie_cols=["doc_id", "n_features"])
    rank = F.when(F.col("before") < n, F.col("before") + 1).cast("long")
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, rank.alias("rank")).unionByName(
        rows.filter(~able).select(*out, F.lit(None).cast("long").alias("rank")))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """Rows of ``docs`` whose ids were drawn, with all their columns."""
    at = docs.columns.index(id_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    ids = resample(docs, target, id_col, **how).filter("rank is not null").select("doc_id").distinct()
    return plain.join(ids, plain[f"c{at}"].eqNullSafe(ids["doc_id"]), "left_semi").toDF(*docs.columns)


# The twin forms every run's bytes and folds them through the byte table, which it makes itself.
_FEATURES = r"""SELECT {id} AS doc_id, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: array_to_string(w[i:i + 1], ' ')),
    list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))) AS f
  FROM (SELECT {id}, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {table})"""
SQL = r"""
WITH tbl AS (SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))),
df AS (""" + _FEATURES.format(id="doc_id", table="documents") + """),
bf AS (""" + _FEATURES.format(id="item_id", table="benchmark") + """),
hashed AS (SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(len(x) // 2),
      lambda i: CAST('0x' || x[2 * i + 1:2 * i + 2] AS BIGINT))),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 10000 AS b
  FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT f FROM df UNION SELECT f FROM bf)), tbl),
s AS (SELECT b, count(*) AS n FROM df JOIN hashed USING (f) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM bf JOIN hashed USING (f) GROUP BY b),
gain AS (SELECT b, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM s) + 10000.0::DOUBLE)
      / ((coalesce(s.n, 0) + 1.0::DOUBLE) * ((SELECT coalesce(sum(n), 0) FROM t) + 10000.0::DOUBLE)))) AS BIGINT) AS g
  FROM range(10000) r(b) LEFT JOIN s USING (b) LEFT JOIN t USING (b)),
w AS (SELECT doc_id, count(*) AS n_features, sum(g) AS weight FROM df JOIN hashed USING (f) JOIN gain USING (b) GROUP BY doc_id),
d AS (SELECT doc_id, CAST('0x' || sha256('42:' || doc_id)[1:8] AS BIGINT) AS h, coalesce(n_features, 0) AS n_features,
    CAST(coalesce(weight, 0) AS BIGINT) AS weight FROM documents LEFT JOIN w USING (doc_id)),
z AS (SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, n_features >= 57 AS able,
    weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY able ORDER BY score DESC, doc_id) AS k FROM z)
SELECT doc_id, n_features, weight, score,
  CASE WHEN able AND k <= 5 * (SELECT count(*) FROM z WHERE able) // 100 THEN k END AS rank FROM r"""
