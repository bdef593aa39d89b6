"""Substring dedup on a compacted de Bruijn graph of words.

A window of ``K`` consecutive words is an edge of the graph (from its first to
its last K - 1 words).  A word goes if a window over it also starts in a
document with a smaller id.

1. *Paths.*  Every window's least hash of K div 4 words (the leftmost of equal
   ones) is its anchor; consecutive windows with one anchor make a path, a row
   of about K / 3 windows.  Equal windows have equal anchors at equal places,
   so windows of different documents can only be equal in paths of one anchor.
2. *Repeats.*  Anchors that one document alone has are dropped: nothing in their
   paths repeats.  The other paths are grouped by their words (the anchor's hash
   and an independent one of the whole path, 64 bits each), with the least place
   in the corpus that holds each, map-side combined.
3. *Compaction.*  A path that is its anchor's only one has no branch inside.
   It is glued to the path before it where all its occurrences follow that one
   and there are as many (a join of the paths with the paths before them); runs
   of glued paths are one long path, found at its least place.  Where an anchor
   has several paths the graph branches, or a text begins or ends: their windows
   are looked up one by one.
4. *Verification.*  Every repeated span now names the least place that holds it.
   The source documents give the SHA-256 of the words there; a span goes only
   if its own words have the same.  (Different words behind equal 128-bit hashes
   would stay.)

All groups are aggregates or equi joins; a passage that a third of the
documents share is one row per task in them, and its copies are rows of a join
whose side Spark can split.

Defined cases: NULL or wordless texts have no words; texts of fewer than K
words keep all; NULL ids are smaller than all others and equal to each other;
rows of one id never remove words from each other, whether their texts are
equal or not; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pick, pieces, written

K = 50
KEY = ["anchor", "p"]  # of a path
STEP = 1 << 18  # windows at a time
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)  # odd multipliers


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the words of a text, a bounded piece of it at a time."""
    out = [np.zeros(0, np.uint64)]
    for piece in pieces((text or "").encode("utf-8", "replace")):
        words = piece.split()
        out.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    return np.concatenate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(32)) * M2
    return h ^ h >> np.uint64(29)


def rolled(h: np.ndarray, sizes: list[int], m: np.uint64) -> dict[int, np.ndarray]:
    """For each size s the hashes sum(h[i + j] * m^j, j < s) of all runs of s
    elements, put together from runs of powers of two."""
    power, have, doubled = {1: m}, {1: h}, 1
    while 2 * doubled <= max(sizes):
        have[2 * doubled] = have[doubled][:max(len(h) - 2 * doubled + 1, 0)] + power[doubled] * have[doubled][doubled:]
        power[2 * doubled] = power[doubled] * power[doubled]
        doubled *= 2
    out = {}
    for s in sizes:
        n, at, scale = max(len(h) - s + 1, 0), 0, np.uint64(1)
        total = np.zeros(n, np.uint64)
        for p in sorted(have, reverse=True):
            if s & p:
                total += scale * have[p][at:at + n]
                at, scale = at + p, scale * power[p]
        out[s] = mixed(total)
    return out


def least_at(a: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least element of every run of ``width`` elements."""
    best, have = np.arange(len(a)), 1
    while have < width:
        step = min(have, width - have)
        left, right = best[:len(best) - step], best[step:]
        best = np.where(a[left] <= a[right], left, right)
        have += step
    return best


def windows(h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of every window of k word hashes."""
    with np.errstate(over="ignore"):
        return rolled(h, [k], M1)[k], rolled(mixed(h), [k], M2)[k]


def paths_of(h: np.ndarray, k: int = K, step: int = STEP) -> Iterator[tuple[np.ndarray, ...]]:
    """(start, windows, anchor, hash, hash of the path before or 0) of the paths
    of one text, given its word hashes; a bounded number of windows at a time."""
    before, anchor = np.uint64(0), max(k // 4, 1)
    for a in range(0, len(h) - k + 1, step):
        part = h[a:a + step + k - 1]
        one, two = windows(part, k)
        with np.errstate(over="ignore"):
            small = rolled(part, [anchor], M1)[anchor]
        at = least_at(small, k - anchor + 1)
        start = np.flatnonzero(np.diff(at, prepend=-1))
        size = np.diff(start, append=len(at))
        with np.errstate(over="ignore"):  # the first and the last window hold all its words
            whole = mixed((one[start] * M1 ^ two[start + size - 1]) + size.astype(np.uint64))
        yield start + a, size, small[at[start]], whole, np.concatenate([[before], whole[:-1]])
        before = whole[-1]


def signed(a: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(a, np.uint64).view(np.int64))


def occurrences(rows: DataFrame, k: int, step: int) -> DataFrame:
    """(id, row (hash of the text), text) -> a row per path: id, row, pos, n, anchor, p, before."""
    id_type = rows.schema["id"].dataType.simpleString()
    names = ["id", "row", "pos", "n", *KEY, "before"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, docs, held = [], [], 0

            def flush() -> pa.RecordBatch:
                at = pa.array(np.repeat(docs, [len(f[0]) for f in found]))
                pos, n, *keys = (np.concatenate(c) for c in zip(*found))
                return pa.RecordBatch.from_arrays([batch["id"].take(at), batch["row"].take(at), pa.array(pos.astype(np.int32)),
                                                   pa.array(n.astype(np.int32)), *map(signed, keys)], names)

            for i, text in enumerate(batch["text"]):
                for some in paths_of(word_hashes(text.as_py()), k, step):
                    found.append(some)
                    docs.append(i)
                    held += len(some[0])
                    if held >= STEP // 4:
                        yield flush()
                        found, docs, held = [], [], 0
            if found:
                yield flush()

    return written(rows.mapInArrow(scan, f"id {id_type}, row long, pos int, n int, anchor long, p long, before long"))


def with_spans(rows: DataFrame, spans: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with all structs of ``spans`` (id, row, span) of their own as an array ``spans``."""
    own = spans.groupBy(F.col("id").alias("sid"), F.col("row").alias("srow")).agg(F.collect_list("span").alias("spans"))
    return rows.join(own, rows["id"].eqNullSafe(own["sid"]) & (rows["row"] == own["srow"]), how).drop("sid", "srow")


def edges(rows: DataFrame, branching: DataFrame, k: int) -> DataFrame:
    """The windows of paths (key, place, last), one by one: key, last, no (of the
    window in the path), place (id, row, pos: its own) and its two hashes e, f."""
    asked = branching.select("place.id", "place.row", F.struct("place.pos", "n", *KEY, "last").alias("span"))
    id_type = rows.schema["id"].dataType.simpleString()
    names = ["id", "row", "pos", "last", *KEY, "no", "e", "f"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (text, spans) in enumerate(zip(batch["text"], batch["spans"])):
                h = word_hashes(text.as_py())
                for s in range(0, len(spans), STEP // 64):
                    some = spans.values[s:s + STEP // 64].to_pylist()
                    pos, n = (np.array([x[c] for x in some], np.int64) for c in ("pos", "n"))
                    # the words of every path, one path after the other; windows over a seam are left out
                    width = n + k - 1
                    seam = np.cumsum(width) - width
                    one, two = windows(h[np.arange(width.sum()) + np.repeat(pos - seam, width)], k)
                    path = np.repeat(np.arange(len(some)), n)
                    no = np.arange(len(path)) - (np.cumsum(n) - n)[path]
                    at, of = pa.array(np.full(len(path), i)), pa.array(path)
                    yield pa.RecordBatch.from_arrays(
                        [batch["id"].take(at), batch["row"].take(at), pa.array((pos[path] + no).astype(np.int32)),
                         pa.array([x["last"] for x in some], batch["id"].type).take(of),
                         *[pa.array([x[c] for x in some], pa.int64()).take(of) for c in KEY],
                         pa.array(no.astype(np.int32)), signed(one[no + seam[path]]), signed(two[no + seam[path]])], names)

    return written(with_spans(rows, asked).select("id", "row", "text", "spans").mapInArrow(
        scan, f"id {id_type}, row long, pos int, last {id_type}, anchor long, p long, no int, e long, f long"))


def compact(paths: DataFrame) -> DataFrame:
    """Unbranched paths glued to long ones: key (of the first of them), no (0),
    size (windows) and source, the least place."""
    prior = paths.select(F.col("p").alias("before"), F.col("count").alias("prior"))
    glued = paths.filter("before = other and before <> 0").join(prior, "before").filter("prior = count") \
        .select(*KEY, F.lit(1).alias("glued"))
    # a glued path's least place is right behind that of the path before it, in the same document
    along = Window.partitionBy("place.id", "place.row").orderBy("place.pos").rowsBetween(Window.unboundedPreceding, 0)
    marked = paths.join(glued, KEY, "left").withColumn("run", F.sum(1 - F.coalesce("glued", F.lit(0))).over(along))
    return marked.groupBy("place.id", "place.row", "run").agg(
        F.min_by(F.struct(*KEY, "place"), "place.pos").alias("head"), F.sum("n").cast("int").alias("size")) \
        .select("head.*", F.lit(0).alias("no"), "size").withColumnRenamed("place", "source")


def resolve(each: DataFrame) -> DataFrame:
    """Windows of branching paths -> key, no, size and source of their runs that
    have one least place and an occurrence of the path in a later document."""
    least = each.groupBy("e", "f").agg(F.min(F.struct("id", "row", "pos")).alias("source"))
    found = each.join(least, ["e", "f"]).filter(~F.col("source.id").eqNullSafe(F.col("last")))
    run = [*KEY, "sid", "srow", "diagonal"]
    found = found.select(*KEY, "no", F.col("source.id").alias("sid"), F.col("source.row").alias("srow"),
                         (F.col("source.pos") - F.col("no")).alias("diagonal"))
    found = found.withColumn("island", F.col("no") - F.row_number().over(Window.partitionBy(*run).orderBy("no")))
    runs = found.groupBy(*run, "island").agg(F.min("no").alias("no"), F.count("*").cast("int").alias("size"))
    return runs.select(*KEY, "no", "size", F.struct(F.col("sid").alias("id"), F.col("srow").alias("row"),
                                                    (F.col("diagonal") + F.col("no")).alias("pos")).alias("source"))


def repeated(rows: DataFrame, k: int = K, step: int = STEP) -> DataFrame:
    """(id, row, text) -> repeated spans: id, row, pos (first word), size
    (windows) and the least place that holds them, source (id, row, pos)."""
    occ = occurrences(rows, k, step)
    # written, so that both sides of the join are dealt anew and a hot anchor's side can be split
    shared = written(occ.groupBy("anchor").agg(
        F.min("id").alias("least"), F.max("id").alias("most"), F.count("id").alias("ids"), F.count("*").alias("all"),
        (F.min("p") == F.max("p")).alias("single")) \
        .filter("least < most or ids > 0 and ids < all").select("anchor", "single"))
    occ = written(occ.join(shared, "anchor"))
    paths = written(occ.groupBy(*KEY, "n", "single").agg(
        F.count("*").alias("count"), F.min(F.struct("id", "row", "pos")).alias("place"), F.max("id").alias("last"),
        F.min("before").alias("before"), F.max("before").alias("other")))
    decided = compact(paths.filter("single")).unionByName(resolve(edges(rows, paths.filter("not single"), k)))
    return occ.join(decided, KEY).filter(~F.col("id").eqNullSafe(F.col("source.id"))).select(
        "id", "row", (F.col("pos") + F.col("no")).alias("pos"), "size", "source")


class Words:
    """A text's words, joined by one space: any range of them is a slice."""

    def __init__(self, text: str | None):
        parts, sizes = [], [np.zeros(1, np.int64)]
        for piece in pieces((text or "").encode("utf-8", "replace")):
            words = piece.split()
            if words:
                parts.append(b" ".join(words))
                sizes.append(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        self.data = b" ".join(parts)
        self.start = np.cumsum(np.concatenate(sizes))
        self.n = len(self.start) - 1

    def part(self, a: int, b: int) -> bytes:
        """Words a to b - 1."""
        return self.data[self.start[a]:self.start[b] - 1] if a < b else b""

    def digest(self, pos: int, size: int, k: int) -> bytes:
        """SHA-256 of the words of ``size`` consecutive windows."""
        return hashlib.sha256(self.part(pos, pos + size + k - 1)).digest() if pos + size + k - 1 <= self.n else b""


def sources(rows: DataFrame, spans: DataFrame, k: int) -> DataFrame:
    """(id, row, pos, size, digest) of the distinct places that ``spans`` name as sources."""
    asked = spans.select("source", "size").distinct().select(
        "source.id", "source.row", F.struct("source.pos", "size").alias("span"))
    id_type = rows.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (text, spans) in enumerate(zip(batch["text"], batch["spans"])):
                words = Words(text.as_py())
                for s in range(0, len(spans), STEP // 4):
                    some = spans.values[s:s + STEP // 4].to_pylist()
                    at = pa.array(np.full(len(some), i))
                    yield pa.RecordBatch.from_arrays(
                        [batch["id"].take(at), batch["row"].take(at), *[pa.array([x[c] for x in some], pa.int32()) for c in (
                            "pos", "size")], pa.array([words.digest(x["pos"], x["size"], k) for x in some], pa.binary())],
                        ["id", "row", "pos", "size", "digest"])

    return with_spans(rows, asked).select("id", "row", "text", "spans").mapInArrow(
        scan, f"id {id_type}, row long, pos int, size int, digest binary")


def cut(rows: DataFrame, k: int = K, step: int = STEP) -> DataFrame:
    """(id, row, text, ...) -> all columns, with the kept words joined by one
    space for ``text``, and n_words, n_removed."""
    bare = rows.select("id", "row", "text")
    spans = written(repeated(bare, k, step))
    known = sources(bare, spans, k)
    same = spans["source.id"].eqNullSafe(known["id"]) & (spans["source.row"] == known["row"]) \
        & (spans["source.pos"] == known["pos"]) & (spans["size"] == known["size"])
    checked = spans.join(known, same).select(spans["id"], spans["row"], F.struct(
        spans["pos"], spans["size"], known["digest"]).alias("span"))
    whole = with_spans(rows, checked, "left")
    names = [c for c in whole.columns if c != "spans"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_words, n_removed = [], [], []
            for text, spans in zip(batch["text"], batch["spans"]):
                words, edge = Words(text.as_py()), np.zeros(1, np.int64)
                if spans.is_valid:
                    edge = np.zeros(words.n + 1, np.int64)
                    for s in spans:
                        pos, size, digest = s["pos"].as_py(), s["size"].as_py(), s["digest"].as_py()
                        if digest and words.digest(pos, size, k) == digest:
                            edge[pos] += 1
                            edge[pos + size + k - 1] -= 1
                if edge.any():
                    gone = np.cumsum(edge[:-1]) > 0
                    turn = np.flatnonzero(np.diff(gone, prepend=True, append=True)).tolist()
                    kept.append(b" ".join(words.part(a, b) for a, b in zip(turn[::2], turn[1::2])))
                    n_removed.append(int(gone.sum()))
                else:
                    kept.append(words.data)
                    n_removed.append(0)
                n_words.append(words.n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept, pa.binary()).cast(pa.string()) if c == "text" else batch[c] for c in names]
                + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())], [*names, "n_words", "n_removed"])

    schema = T.StructType([whole.schema[c] for c in names] + [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return whole.select(*names, "spans").mapInArrow(scan, schema)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, step: int = STEP) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words per document."""
    rows = pick(docs, id=id_col, text=text_col).withColumn("row", F.xxhash64("text"))
    return cut(rows, k, step).select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                               F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K) -> DataFrame:
    """``docs``, all columns, with the kept words joined by one space as the text."""
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    plain = docs.toDF(*inner)
    text = f"c{names.index(text_col)}"
    rows = plain.select(F.col(f"c{names.index(id_col)}").alias("id"), F.col(text).alias("text"),
                        F.xxhash64(text).alias("row"), F.struct(*[c for c in inner if c != text]).alias("rest"))
    return cut(rows, k).select(*[F.col("text") if c == text else F.col(f"rest.{c}") for c in inner]).toDF(*names)


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + {K - 1}], ' ')) AS h
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - {K - 2})) AS i FROM d)),
least AS (SELECT h, min(doc_id) AS m FROM win GROUP BY h),
late AS (SELECT doc_id, i FROM win JOIN least USING (h) WHERE doc_id > m),
word AS (SELECT doc_id, generate_subscripts(w, 1) AS i, unnest(w) AS t FROM d),
marked AS (SELECT word.doc_id, word.i, t, max(late.i) OVER (PARTITION BY word.doc_id ORDER BY word.i) AS hit
           FROM word LEFT JOIN late ON late.doc_id = word.doc_id AND late.i = word.i),
kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY i) AS k, count(*) AS n FROM marked
         WHERE hit IS NULL OR hit < i - {K - 1} GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""
