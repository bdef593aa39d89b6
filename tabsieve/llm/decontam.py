"""Benchmark decontamination by greedy string tiling.

Texts become tokens (ASCII punctuation and white space separate, A-Z are
lower-cased).  A document is contaminated by a benchmark item if tiles, matches
of ``min_match`` tokens or more that overlap neither in the document nor in the
item, cover ``coverage`` of the item's tokens.  As tiles may come in any order,
reordered passages are caught; isolated common phrases are not enough.

1. *Seeds*: one Karp-Rabin pass per text hashes every window of ``min_match``
   tokens.  A Bloom filter of the benchmark's windows (bounded size) thins the
   documents' windows out in the scan; the rest are equi-joined with the
   benchmark's on the window's tokens themselves, so hash collisions drop out.
2. *Tiles*: per (document, item) pair, consecutive seeds on a diagonal chain to
   maximal matches; the longest is marked, others lose the marked tokens, until
   none of ``min_match`` tokens is left.
3. *Threshold* on covered item tokens.

Only windows that occur in the benchmark are shuffled; a passage that a third
of the documents share is a join key whose document side Spark can split (or
the benchmark is broadcast, when its size is under Spark's threshold).

Defined cases: NULL or empty texts and items shorter than ``min_match`` match
nothing; repeated rows of a document or an item are tiled each by itself and
the best coverage counts; NULL ids are ids like any other; other columns are
ignored.  Of equally long matches the first in the item, then in the document,
is marked.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import bloom

MIN_MATCH, COVERAGE = 5, 0.8
PIECE = 1 << 18  # bytes hashed at a time
SEPARATORS = bytes(range(0x09, 0x0E)) + b" !\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FOLD = bytes.maketrans(bytes(range(65, 91)) + SEPARATORS, bytes(range(97, 123)) + b" " * len(SEPARATORS))
BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2^64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


POWERS, INVERSE = _powers(BASE, 1024), _powers(pow(BASE, -1, 1 << 64), 1024)


def _grow(n: int) -> None:
    global POWERS, INVERSE
    if len(POWERS) < n:
        size = 1 << (n - 1).bit_length()
        POWERS, INVERSE = _powers(BASE, size), _powers(pow(BASE, -1, 1 << 64), size)


def folded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").translate(FOLD)


def token_hashes(text: bytes) -> np.ndarray:
    """64-bit hash per token of a folded text: differences of prefix sums of
    byte * BASE^position, shifted to position 0, then mixed."""
    out, at = [np.empty(0, np.uint64)], 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            cut = text.rfind(b" ", at, end)
            end = cut if cut > at else (text.find(b" ", end) + 1 or len(text))
        b = np.frombuffer(text, np.uint8, min(end, len(text)) - at, at)
        at = end
        _grow(len(b) + 1)
        edge = np.diff(np.concatenate([[0], (b != 32).view(np.int8), [0]]))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        total = np.zeros(len(b) + 1, np.uint64)
        np.cumsum(b.astype(np.uint64) * POWERS[:len(b)], out=total[1:])
        h = (total[stop] - total[start]) * INVERSE[start]
        h = (h ^ (h >> np.uint64(29)) ^ (stop - start).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        out.append(h ^ (h >> np.uint64(32)))
    return np.concatenate(out)


def window_hashes(text: bytes, k: int) -> np.ndarray:
    """Karp-Rabin hash of every window of k tokens."""
    h = token_hashes(text)
    n = max(len(h) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + h[i:i + n]
    return out ^ (out >> np.uint64(31))


def windows(rows: DataFrame, k: int, only: bloom.Bloom | None = None) -> DataFrame:
    """(id, text) -> id, row (hash of the text as Spark's xxhash64, tells rows of
    one id apart), n (tokens of the text), at, h and seed (the window's tokens) per window;
    only those that may be in ``only``."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for doc_id, text in zip(b["id"], b["text"]):
                t = folded(text.as_py())
                h = window_hashes(t, k)
                at = np.arange(len(h)) if only is None else only.hits(h)
                if not len(at):
                    continue
                w = t.split()
                for s in range(0, len(at), 1 << 14):
                    part = at[s:s + (1 << 14)]
                    m = len(part)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([doc_id.as_py()] * m, b["id"].type),
                        pa.array(np.full(m, xxhash.xxh64_intdigest(text.as_py().encode("utf-8", "replace"), 42), np.uint64)
                                 .view(np.int64)),
                        pa.array(np.full(m, len(w), np.int64)), pa.array(part.astype(np.int64)),
                        pa.array(h[part].view(np.int64)),
                        pa.array([b" ".join(w[i:i + k]).decode() for i in part.tolist()], pa.string())],
                        ["id", "row", "n", "at", "h", "seed"])

    return rows.mapInArrow(run, f"id {id_type}, row long, n long, at long, h long, seed string")


def tile(seeds: list[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (item position, document position, length) from the
    (item, document) positions of equal windows of k tokens."""
    runs: list[list[int]] = []
    for i, d in sorted(set(seeds), key=lambda s: (s[1] - s[0], s[0])):
        if runs and runs[-1][1] - runs[-1][0] == d - i and runs[-1][0] + runs[-1][2] == i:
            runs[-1][2] += 1
        else:
            runs.append([i, d, 1])
    heap = [(-(n + k - 1), i, d) for i, d, n in runs]
    heapq.heapify(heap)
    in_item, in_doc, tiles = set(), set(), []
    while heap:
        n, i, d = heapq.heappop(heap)
        free, at = [], 0
        for o in range(-n + 1):  # maximal stretches of tokens not marked yet
            if o == -n or i + o in in_item or d + o in in_doc:
                if o - at >= k:
                    free.append((-(o - at), i + at, d + at))
                at = o + 1
        if free == [(n, i, d)]:
            tiles.append((i, d, -n))
            in_item.update(range(i, i - n))
            in_doc.update(range(d, d - n))
        else:
            for f in free:
                heapq.heappush(heap, f)
    return tiles


def _matches(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE,
            id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """doc_id, doc_row (hash of the text), item_id, coverage, n_tiles and
    longest of every contaminated pair of rows."""
    items = cut_lineage(windows(benchmark.select(F.col(item_col).alias("id"), F.col("text")), min_match))
    n = items.agg(F.count("*")).first()[0]
    seeds = windows(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), min_match,
                    bloom.build(items.select("h").distinct(), n))
    d = seeds.select("seed", F.col("id").alias("doc_id"), F.col("row").alias("doc_row"), F.col("at").alias("d"))
    i = items.select("seed", F.col("id").alias("item_id"), F.col("row").alias("item_row"), "n", F.col("at").alias("i"))
    pairs = d.join(i, "seed").groupBy("doc_id", "doc_row", "item_id", "item_row", "n") \
        .agg(F.collect_set(F.struct("i", "d")).alias("seeds"))
    # tiles of k tokens or more that cover c tokens hold at least c / k windows in order
    pairs = pairs.filter(F.size("seeds") * min_match >= F.ceil(F.col("n") * coverage))
    types = {f.name: f.dataType.simpleString() for f in pairs.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tiles = [tile([(s["i"], s["d"]) for s in x.as_py()], min_match) for x in b["seeds"]]
            total = np.asarray(b["n"])
            yield pa.RecordBatch.from_arrays([
                b["doc_id"], b["doc_row"], b["item_id"],
                pa.array([sum(t[2] for t in ts) / n for ts, n in zip(tiles, total.tolist())], pa.float64()),
                pa.array([len(ts) for ts in tiles], pa.int64()),
                pa.array([max(t[2] for t in ts) for ts in tiles], pa.int64())],
                ["doc_id", "doc_row", "item_id", "coverage", "n_tiles", "longest"])

    return pairs.mapInArrow(run, f"doc_id {types['doc_id']}, doc_row long, item_id {types['item_id']}, coverage double, "
                                 "n_tiles long, longest long").filter(F.col("coverage") >= coverage)


def matches(docs: DataFrame, benchmark: DataFrame, *args, **kw) -> DataFrame:
    """doc_id, item_id, coverage (share of the item's tokens under tiles),
    n_tiles and longest (tokens) of every contaminated pair."""
    tiled = _matches(docs, benchmark, *args, **kw)
    return tiled.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "n_tiles", "longest")).alias("m")) \
        .select("doc_id", "item_id", "m.*")


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          keep_null: bool = True, **kw) -> DataFrame:
    """``docs`` without the contaminated ones, by id and text: another text under
    the same id stays.  With ``keep_null``, rows without id stay whatever their text."""
    bad = _matches(docs, benchmark, id_col=id_col, text_col=text_col, **kw) \
        .select(F.col("doc_id").alias("__bad"), F.col("doc_row").alias("__row")).distinct()
    if keep_null:
        bad = bad.filter("__bad IS NOT NULL")
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__bad")) & (F.xxhash64(text_col) == F.col("__row")), "left_anti")
