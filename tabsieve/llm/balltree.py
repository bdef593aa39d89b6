"""Ranked lexical search: exact top-k by ball trees of sparse vectors.

A document is a sparse vector with w(t) * ((10^9 * tf) div (1000 * tf + 8 * m))
at every term t; an item is the vector of its terms' counts, and their inner
product is the score, all in 64-bit integers.  Only terms of the items matter.

1. Every document becomes a row: its number of terms, and the counts of those
   that an item holds.  N, L and the document frequencies are sums over it.
2. Each task deals its documents into ball trees (``TREE`` documents, halved
   between two far points down to ``LEAF``).  A node keeps the centroid c of its
   documents, their largest distance r from it, and the radius u(t) along every
   single term's axis, so no inner product with an item q exceeds <q, c> plus
   the lesser of |q| r and <q, u>: the ball for documents alike, the radii along
   the item's few axes for the others.  Centroids, radii and bounds are doubles;
   each is widened by more than its rounding error, so a bound is never short.
3. For every item a tree's nodes are opened best bound first, until no bound
   reaches the k-th score found in the task so far; leaves are scored exactly.
   A task emits k rows an item; a window over those ranks them.

Items are searched in blocks of about ``BLOCK`` (item, term) pairs, so that
what a task holds of them is bounded; documents are never compared with each
other, and a tree never holds more than ``TREE`` of them.

Defined cases: NULL or term-free documents have score 0 and do not count in N;
NULL or term-free items give no rows; equal scores go by ascending id, NULL
last; rows sharing a doc_id are documents of their own; an item is an (id,
text) pair, so repeated rows of it count once, and two texts under one id are
ranked each by itself; empty tables give no rows; other columns do not matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import folded_words, pick, written

TOP, TREE, LEAF = 10, 2048, 32
BLOCK = 1 << 16  # (item, term) pairs searched at a time
SLACK = 1e-9  # relative; over 2^16 additions of doubles err by less than 2e-11


def term_counts(text: str | None, known: dict[bytes, int]) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of terms of a text; numbers and counts of those in ``known``."""
    n, parts = 0, [np.zeros(0, np.int32)]
    for words in folded_words(text):
        n += len(words)
        ids = np.fromiter((known.get(w, -1) for w in words), np.int32, len(words))
        parts.append(ids[ids >= 0])
    term, tf = np.unique(np.concatenate(parts), return_counts=True)
    return n, term, tf.astype(np.int32)


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, item (hash of the text), term, n) per term of every item."""
    rows = pick(items, item_id=id_col, text=text_col).withColumn("item", F.xxhash64("text"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, terms, n = [], [], []
            for i, text in enumerate(batch["text"]):
                count: dict[bytes, int] = {}
                for words in folded_words(text.as_py()):
                    for w in words:
                        count[w] = count.get(w, 0) + 1
                at += [i] * len(count)
                terms += count
                n += count.values()
            at = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays([batch["item_id"].take(at), batch["item"].take(at),
                                              pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())],
                                             ["item_id", "item", "term", "n"])

    id_type = rows.schema["item_id"].dataType.simpleString()
    return written(rows.mapInArrow(scan, f"item_id {id_type}, item long, term string, n long").distinct())


def take(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the entries of some rows, and for each its row's place in ``rows``."""
    size = ptr[rows + 1] - ptr[rows]
    local = np.repeat(np.arange(len(rows)), size)
    return np.arange(len(local)) + np.repeat(ptr[rows] - (np.cumsum(size) - size), size), local


class BallTree:
    """Documents as sparse rows (``ptr``, ``col``, ``val``: positive 64-bit
    integers, no row empty) in nodes of halves."""

    def __init__(self, ids: list, ptr: np.ndarray, col: np.ndarray, val: np.ndarray, dims: int, leaf: int = LEAF):
        x = val.astype(np.float64)
        n = len(ptr) - 1
        row = np.repeat(np.arange(n), np.diff(ptr))
        square = np.bincount(row, x * x, n)
        self.kids: list[tuple[int, int]] = []  # of a node; a leaf has none, (-1, -1)
        self.span: list[tuple[int, int]] = []  # of its documents in tree order
        self.center, self.radius, top, order = [], [], [], []

        def distance(flat, local, rows, point):
            """Squared distances from a dense point, and how much rounding may hide of them."""
            p2 = point @ point
            dots = np.bincount(local, x[flat] * point[col[flat]], len(rows))
            return square[rows] - 2 * dots + p2, SLACK * (square[rows] + p2)

        def dense(r):
            out = np.zeros(dims)
            out[col[ptr[r]:ptr[r + 1]]] = x[ptr[r]:ptr[r + 1]]
            return out

        def grow(rows) -> int:
            me = len(self.kids)
            flat, local = take(ptr, rows)
            center = np.bincount(col[flat], x[flat], dims) / len(rows)
            far, slack = distance(flat, local, rows, center)
            self.center.append(center)
            self.radius.append(float(np.sqrt(np.maximum(far, 0) + slack).max()) * (1 + SLACK))
            self.kids.append((-1, -1))
            self.span.append((0, 0))
            top.append(np.zeros(dims))
            if len(rows) <= leaf:
                np.maximum.at(top[me], col[flat], x[flat])
                self.span[me] = (len(order), len(order) + len(rows))
                order.extend(rows.tolist())
                return me
            one = dense(rows[far.argmax()])
            off, _ = distance(flat, local, rows, one)
            other = dense(rows[off.argmax()])
            along = np.bincount(local, x[flat] * (other - one)[col[flat]], len(rows))
            halves = rows[np.argsort(along, kind="stable")]
            a, b = self.kids[me] = (grow(halves[:len(rows) // 2]), grow(halves[len(rows) // 2:]))
            np.maximum(top[a], top[b], out=top[me])
            return me

        grow(np.arange(n))
        flat, _ = take(ptr, np.array(order))
        self.ids = [ids[r] for r in order]
        self.col, self.val = col[flat], val[flat]
        self.ptr = np.concatenate([[0], np.cumsum(np.diff(ptr)[order])])
        self.center, self.radius = np.array(self.center), np.array(self.radius)
        self.norm = np.sqrt((self.center ** 2).sum(1))
        self.reach = np.maximum(np.array(top) - self.center, 0)  # u(t): no document lies further out

    def bounds(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """No document of a node scores above its bound."""
        q = float(np.sqrt((counts.astype(np.float64) ** 2).sum()))
        out = np.minimum(q * self.radius, self.reach[:, terms] @ counts)
        return (self.center[:, terms] @ counts + out + SLACK * q * self.norm) * (1 + SLACK) + 1

    def search(self, terms: np.ndarray, counts: np.ndarray, dense: np.ndarray, best: list, k: int) -> int:
        """Improve ``best``, a heap of at most k (score, is an id, -id); ``dense``
        is all zeros and is so again afterwards.  Returns the leaves opened."""
        bound = self.bounds(terms, counts).tolist()
        opened, heap = 0, [(-bound[0], 0)]
        dense[terms] = counts
        while heap:
            top, node = heapq.heappop(heap)
            if len(best) == k and -top < best[0][0]:
                break
            for kid in self.kids[node] if self.kids[node][0] >= 0 else ():
                heapq.heappush(heap, (-bound[kid], kid))
            a, b = self.span[node]
            if a == b:
                continue
            opened += 1
            lo, hi = self.ptr[a], self.ptr[b]
            scores = np.add.reduceat(self.val[lo:hi] * dense[self.col[lo:hi]], self.ptr[a:b] - lo)
            least = max(best[0][0] if len(best) == k else 1, 1)
            for i in np.flatnonzero(scores >= least).tolist():
                doc_id = self.ids[a + i]
                entry = (int(scores[i]), doc_id is not None, -(doc_id or 0))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        dense[terms] = 0
        return opened


def vectors(docs: DataFrame, known: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): documents with a term, int32 numbers of the known ones and their counts."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, sizes, terms, tfs = [], [], [], []
            for i, text in enumerate(batch["text"]):
                n, term, tf = term_counts(text.as_py(), known)
                if n:
                    at.append(i)
                    sizes.append(n)
                    terms.append(term.tobytes())
                    tfs.append(tf.tobytes())
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(at, pa.int32())), pa.array(sizes, pa.int64()),
                                              pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                                             ["doc_id", "n", "terms", "tfs"])

    return written(docs.mapInArrow(scan, "doc_id long, n long, terms binary, tfs binary"))


def frequencies(table: DataFrame, dims: int) -> np.ndarray:
    """Documents per known term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims, np.int64)
        for batch in batches:
            terms = np.frombuffer(b"".join(batch["terms"].to_pylist()), np.int32)
            total += np.bincount(terms, minlength=dims)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["term", "df"])

    found = table.select("terms").mapInArrow(count, "term int, df long") \
        .groupBy("term").agg(F.sum("df").alias("df")).toArrow()  # a row per term of the block at most
    out = np.zeros(dims, np.int64)
    out[found["term"].to_numpy()] = found["df"].to_numpy()
    return out


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def _block(docs: DataFrame, found: pa.Table, id_type: str, k: int) -> DataFrame:
    """Top k per task and item of one block (item_id, item, term, n)."""
    known = {t.encode(): i for i, t in enumerate(sorted(set(found["term"].to_pylist())))}
    queries: dict[tuple, tuple[list, list]] = {}
    for item_id, item, term, n in zip(*[found[c].to_pylist() for c in ("item_id", "item", "term", "n")]):
        terms, ns = queries.setdefault((item_id, item), ([], []))
        terms.append(known[term.encode()])
        ns.append(n)
    asked = [(key, np.array(t, np.int64), np.array(n, np.int64)) for key, (t, n) in sorted(
        queries.items(), key=lambda q: q[0][1])]
    table = vectors(docs, known)
    row = table.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    n_docs, n_terms = row["docs"], row["terms"]
    weight = weights(frequencies(table, len(known)), n_docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in asked]
        dense = np.zeros(len(known), np.int64)

        def tree(rows):
            m = np.array([25 + 75 * n * n_docs // n_terms for _, n, _, _ in rows], np.int64)
            size = np.array([len(t) // 4 for _, _, t, _ in rows], np.int64)
            col = np.frombuffer(b"".join(r[2] for r in rows), np.int32).astype(np.int64)
            tf = np.frombuffer(b"".join(r[3] for r in rows), np.int32).astype(np.int64)
            val = weight[col] * (10 ** 9 * tf // (1000 * tf + 8 * np.repeat(m, size)))
            one = BallTree([r[0] for r in rows], np.concatenate([[0], np.cumsum(size)]), col, val, len(known))
            for (_, terms, counts), heap in zip(asked, best):
                one.search(terms, counts, dense, heap, k)

        rows = []
        for batch in batches:
            for r in zip(*[batch[c].to_pylist() for c in ("doc_id", "n", "terms", "tfs")]):
                if r[2]:
                    rows.append(r)
                if len(rows) == TREE:
                    tree(rows)
                    rows = []
        if rows:
            tree(rows)
        out = [(*key, -neg if is_id else None, score) for (key, _, _), heap in zip(asked, best) for score, is_id, neg in heap]
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], found["item_id"].type),
                                          pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()),
                                          pa.array([o[3] for o in out], pa.int64())], ["item_id", "item", "doc_id", "score"])

    return table.mapInArrow(run, f"item_id {id_type}, item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", block: int = BLOCK) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents (score above 0)
    of every item, and ``item``, the hash of its text."""
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    asked = item_terms(items, item_col, item_text)
    id_type = asked.schema["item_id"].dataType.simpleString()
    blocks = max(1, -(-asked.count() // block))
    found = None
    for b in range(blocks):
        some = asked.filter(F.pmod("item", F.lit(blocks)) == b).toArrow()  # about ``block`` rows
        if some.num_rows:
            part = _block(rows, some, id_type, k)
            found = part if found is None else found.unionByName(part)
    if found is None:
        found = docs.sparkSession.createDataFrame([], f"item_id {id_type}, item long, doc_id long, score long")
    order = Window.partitionBy("item_id", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k) \
        .select("item_id", "rank", "doc_id", "score", "item")


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
         r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS t FROM documents),
tf AS (SELECT doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
len AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
tot AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM len),
w AS (SELECT t, CAST(floor(1000 * ln((2.0::DOUBLE * (SELECT nn FROM tot) + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w
      FROM tf GROUP BY t),
q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nn) // ll)))) AS BIGINT) AS score
      FROM q JOIN w USING (t) JOIN tf USING (t) JOIN len USING (doc_id), tot GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10"""
