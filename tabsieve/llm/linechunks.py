r"""Line dedup by content-defined chunks of lines.

A text's lines are hashed, and a rolling hash over the last ``WINDOW`` line
hashes decides where a chunk of ``MIN_LINES`` lines or more ends.  Boundaries
depend only on the lines around them, so a passage inserted or shifted inside a
document is cut the same way as everywhere else.  One such rule finds a repeated
passage only where its boundaries fall well, so a text is cut by ``RULES`` rules
whose hashes have seeds of their own.  Chunks that occur earlier in the corpus
(smaller document, or earlier in the same one) are removed, once their bytes
have been compared: the union over all rules.  A line that goes lies in a run of
two lines or more that occurs earlier; on the given texts the rules find 0.95
of the lines of such runs (README).  Single lines are never a chunk.

1. The scan emits a hash per chunk: no text.
2. Hashes that occur twice go into a Bloom filter (bounded size); a second scan
   emits the text of the chunks that may be repeated.
3. Byte comparison: grouping by the text itself, with map-side combine, finds
   the first place of each; the other places join back on (hash, text digest)
   and are removed.  A chunk in a third of the documents is one row per task in
   the aggregate, and a join key whose side Spark can split.

Defined cases: lines end at \n (a carriage return belongs to its line); blank
lines are lines; the last chunk ends with the text; NULL and empty texts have
no chunk and stay as they are; an earlier occurrence in the same document ends
before the chunk starts; documents are ordered by id, NULL first, then by
a hash of the text, so different texts under one id or without id are different
documents; rows equal in id and text are the same document with the same
places, and get the same result; an empty table gives no rows; all other columns
pass through, whatever their names (``removed`` comes last, also beside one
of that name).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import bloom
from .common import pick, written

WINDOW, MIN_LINES, RULES = 2, 2, 8
DENSITY = 4, 5  # of the places where a chunk may end, it does
MOST_ROWS, MOST_BYTES = 1 << 14, 1 << 23  # of a batch of chunks
MULTIPLIER, MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


def cuts(hashes: list[int], rule: int, window: int = WINDOW) -> list[tuple[int, int]]:
    """(first, end) line numbers of the chunks that one rule makes of a text's line hashes."""
    drop = pow(MULTIPLIER, window, 1 << 64)
    seed, limit = rule * MULTIPLIER + 1 & MASK, (1 << 24) * DENSITY[0] // DENSITY[1]
    out, first, roll = [], 0, 0
    for i, h in enumerate(hashes):
        roll = roll * MULTIPLIER + h
        if i >= window:
            roll -= hashes[i - window] * drop
        roll &= MASK
        if i + 1 - first < MIN_LINES or i + 1 < window:
            continue
        # the high bits of a mixed value: low bits of a product depend on low bits only
        x = (roll ^ seed ^ roll >> 33) * MULTIPLIER & MASK
        if ((x ^ x >> 29) * MULTIPLIER & MASK) >> 40 < limit:
            out.append((first, i + 1))
            first = i + 1
    if len(hashes) - first >= MIN_LINES:
        out.append((first, len(hashes)))
    return out


def chunks(text: str | None, rules: int = RULES) -> list[tuple[int, int]]:
    """(first, end) line numbers of the chunks of a text by all rules, each once,
    in order; ``lines`` of it are ``text.split("\\n")``."""
    if not text:
        return []
    hashes = [xxhash.xxh64_intdigest(x) for x in text.encode("utf-8", "replace").split(b"\n")]
    return sorted({c for rule in range(rules) for c in cuts(hashes, rule)})


def places(rows: DataFrame, only: bloom.Bloom | None = None, rules: int = RULES) -> DataFrame:
    """(id, text) -> id, row (hash of the text), no (first line), n (lines), h (hash of the
    chunk's bytes) and chunk per chunk; with ``only``, those that may be in it, else
    the hashes alone."""
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch() -> pa.RecordBatch:
            h = np.concatenate(hashes).view(np.int64)
            if only is None:
                return pa.RecordBatch.from_arrays([pa.array(h)], ["h"])
            return pa.RecordBatch.from_arrays([
                pa.array(ids, b["id"].type), pa.array(np.array(digests, np.uint64).view(np.int64)),
                pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()), pa.array(h), pa.array(texts, pa.binary()).cast(pa.string())],
                ["id", "row", "no", "n", "h", "chunk"])

        for b in batches:
            ids, digests, numbers, sizes, hashes, texts, n, size = [], [], [], [], [], [], 0, 0
            for doc_id, text in zip(b["id"], b["text"]):
                text = text.as_py()
                found = chunks(text, rules)
                if not found:
                    continue
                data = text.encode("utf-8", "replace")
                row = xxhash.xxh64_intdigest(data, 42)  # as Spark's xxhash64
                at = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
                start = [0, *at.tolist(), len(data) + 1]  # of line i; it ends one byte before the next one's
                for k in range(0, len(found), MOST_ROWS):
                    some = found[k:k + MOST_ROWS]
                    h = np.array([xxhash.xxh64_intdigest(data[start[f]:start[e] - 1]) for f, e in some], np.uint64)
                    if only is not None:
                        pick = only.hits(h).tolist()
                        ids += [doc_id.as_py()] * len(pick)
                        digests += [row] * len(pick)
                        numbers += [some[i][0] for i in pick]
                        sizes += [some[i][1] - some[i][0] for i in pick]
                        texts += [data[start[some[i][0]]:start[some[i][1]] - 1] for i in pick]
                        size += sum(len(t) for t in texts[len(texts) - len(pick):])
                        h = h[pick]
                    hashes.append(h)
                    n += len(h)
                    if n >= MOST_ROWS or size >= MOST_BYTES:
                        yield batch()
                        ids, digests, numbers, sizes, hashes, texts, n, size = [], [], [], [], [], [], 0, 0
            if n:
                yield batch()

    return rows.mapInArrow(run, "h long" if only is None else f"id {id_type}, row long, no long, n long, h long, chunk string")


def repeats(rows: DataFrame, rules: int = RULES) -> DataFrame:
    """(id, text) -> id, row and its chunks (array of no, n) that occur earlier."""
    place = F.struct("id", "row", "no")
    twice = cut_lineage(places(rows, rules=rules).groupBy("h").agg(F.count("*").alias("n"))
                        .filter("n > 1").select("h"))
    some = written(places(rows, bloom.build(twice, twice.count()), rules))
    # written, so that both sides of the join are dealt anew and a hot chunk's side can be split
    first = written(some.groupBy("h", "chunk").agg(F.min(place).alias("a"), F.max(place).alias("b"))
                    .filter(~F.col("a").eqNullSafe(F.col("b"))).select("h", "chunk", F.col("a").alias("first")))
    later = some.join(first, ["h", "chunk"]).filter(
        ~F.col("id").eqNullSafe(F.col("first.id")) | (F.col("row") != F.col("first.row"))
        | (F.col("no") >= F.col("first.no") + F.col("n")))
    return later.groupBy("id", "row").agg(F.array_sort(F.collect_set(F.struct("no", "n"))).alias("gone"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: int = RULES) -> DataFrame:
    """``docs`` with the repeated chunks taken out of the text, and a struct
    ``removed``: n_lines (before), n_removed (lines), n_chunks (removed; those of
    different rules overlap).  A text of which nothing is left is empty."""
    names = docs.columns
    text = names.index(text_col)
    whole = docs.toDF(*[f"c{i}" for i in range(len(names))])  # by position: names of the input do not matter
    whole = whole.select(F.col(f"c{names.index(id_col)}").alias("id"), F.col(f"c{text}").alias("text"), F.struct("*").alias("whole"))
    gone = repeats(whole.select("id", "text"), rules).select(F.col("id").alias("gid"), F.col("row").alias("grow"), "gone")
    out = whole.join(gone, F.col("id").eqNullSafe(F.col("gid")) & (F.xxhash64("text") == F.col("grow")), "left")

    @F.pandas_udf("struct<text string, n_removed long>")
    def without(texts, chunks_gone):
        kept, count = [], []
        for t, g in zip(texts, chunks_gone):
            lines = (t or "").split("\n")
            drop = {i for c in (() if g is None else g) for i in range(c["no"], c["no"] + c["n"])}
            left = [x for i, x in enumerate(lines) if i not in drop]
            kept.append("\n".join(left))
            count.append(len(drop))
        return pd.DataFrame({"text": kept, "n_removed": count})

    hit = F.col("gone").isNotNull()
    out = out.withColumn("cut", F.when(hit, without(F.when(hit, F.col("text")), "gone")))
    n_lines = F.when(F.coalesce("text", F.lit("")) == "", 0).otherwise(F.size(F.split("text", "\n")))
    kept = F.when(hit, F.col("cut.text")).otherwise(F.col("text"))
    return out.select(*[kept.alias(f"c{i}") if i == text else F.col(f"whole.c{i}") for i in range(len(names))], F.struct(
        n_lines.cast("long").alias("n_lines"), F.coalesce("cut.n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_chunks")).alias("removed")).toDF(*names, "removed")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: int = RULES) -> DataFrame:
    """doc_id, n_lines, n_removed, n_chunks and the SHA-256 of the kept text per document."""
    return dedup(pick(docs, doc_id=id_col, text=text_col), rules=rules).select(
        "doc_id", "removed.*", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
