"""Suffix dedup by a run-length index: every byte covered by a LENGTH-byte
string that also starts earlier in the corpus is removed.

**Cutting the corpus into independent parts.**  The least hash of the K-byte
grams in a LENGTH-byte window is its *anchor*; equal windows have equal
anchors.  Successive windows that share an anchor's place form a *stretch* (at
most LENGTH - K + 1 windows), so every window of the corpus belongs to exactly
one stretch, and equal windows meet in the group of their anchor:

1. A scan counts anchors (hash only).  Anchors that occur twice go into a Bloom
   filter of bounded size; nothing else is looked at again.
2. A second scan emits the stretches of those anchors.  Tasks keep one copy of
   equal stretches, the earliest, so exact and near copies shrink before the
   shuffle by anchor.
3. Per task, the groups with several different stretches are indexed, and the
   windows that start earlier elsewhere are marked (:class:`RunIndex`).
4. A last pass takes every window of a repeated anchor as removed unless its
   stretch is listed as the earliest of its kind and the window is not marked.

**Index.**  A run-compressed Burrows-Wheeler transform of the stretches in
corpus order: run heads, starts and per-symbol cumulated lengths, a text
position sampled at both ends of every run, and the earliest text position of
each interval of equal windows.  All stretches are streamed through it from
right to left at once; the interval of the current match grows by backward
steps on the runs up to LENGTH symbols and then slides on, one symbol dropped
for one added.  A match of LENGTH symbols that starts earlier than the stretch
itself marks the window; the sampled position, carried along as the interval's
toehold, lets the bytes be compared as well.

**Crowded anchors** (over ``max(CROWDED, anchors / 65536)`` occurrences, hence
at most 65,536 of them), such as a line shared by a third of the documents,
would make a group grow with the corpus.  Their windows are dealt out one by
one by their own 128-bit hashes, with map-side combine; the earliest of each is
listed.  This is exact too, and no group needs one task.

Defined cases: NULL and short texts keep all their bytes; texts are UTF-8 bytes
and a cut may fall inside a character; documents are ordered by id, NULL first,
then by a hash of the text; rows equal in id and text are the same document, and
get the same result; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import bloom
from .common import written

LENGTH, K = 100, 32
CROWDED = 20_000
COMBINED = 200_000  # stretches or windows that a task combines before it emits them
CHUNK = 1 << 18  # symbols of one index, so that its arrays stay in cache (a group is never split)
PIECE, GROUP = 1 << 18, 1 << 18  # bytes hashed at a time; texts are put together up to about as much
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def gram_hashes(text: bytes) -> np.ndarray:
    """Hash of every K-byte gram: of its four 8-byte words, mixed, weighed and added."""
    n = len(text) - K + 1
    v = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,)) * MIX[0]
    v ^= v >> np.uint64(29)
    v *= MIX[1]
    pair = v[8:] * np.uint64(3)
    pair += v[:-8]
    h = pair[16:] * np.uint64(9)
    h += pair[:n]
    h ^= h >> np.uint64(32)
    h *= MIX[2]
    return h


def window_minima(h: np.ndarray, w: int) -> np.ndarray:
    """Least of every w successive values, by prefix and suffix minima of blocks of w."""
    n = len(h) - w + 1
    padded = np.full(-(-len(h) // w) * w, np.uint64(2**64 - 1))
    padded[:len(h)] = h
    blocks = padded.reshape(-1, w)
    prefix = np.minimum.accumulate(blocks, axis=1).ravel()
    suffix = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(suffix[:n], prefix[w - 1:w - 1 + n])


def stretches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, end) of the stretches of the texts laid end to end:
    windows first .. end - 1, by position in the joined bytes; no window
    crosses a text's end.  A new stretch begins when the anchor's place
    changes: another least value, or the window before began at its (leftmost)
    place.  The bytes are hashed in pieces, which make no difference: a text
    has the same stretches whatever it is laid next to."""
    joined = b"".join(texts)
    size = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(size)
    # places where the windows of a text begin, and end
    edges = np.concatenate([ends - size, np.maximum(ends - LENGTH + 1, ends - size)])
    edges = np.sort(edges[edges < len(joined)])
    windows = max(len(joined) - LENGTH + 1, 0)
    firsts, anchors = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for at in range(0, windows, PIECE):
        back = min(at, 1)  # the window before, to compare with
        part = joined[at - back:at + PIECE + LENGTH - 1]
        h = gram_hashes(part)
        least = window_minima(h, LENGTH - K + 1)
        n = len(least)
        new = np.empty(n, bool)
        new[0] = not back
        np.not_equal(least[1:], least[:-1], out=new[1:])
        new[1:] |= h[:n - 1] == least[:-1]
        new[edges[np.searchsorted(edges, at):np.searchsorted(edges, at - back + n)] - at + back] = True
        first = np.flatnonzero(new)
        firsts.append(first + at - back)
        anchors.append(least[first])
    first, anchor = np.concatenate(firsts), np.concatenate(anchors)
    end = np.append(first[1:], windows)[:len(first)]
    inside = first <= ends[np.searchsorted(ends, first, side="right")] - LENGTH
    return anchor[inside], first[inside], end[inside]


class RunIndex:
    """Run-compressed BWT of byte strings given in corpus order."""

    def __init__(self, strings: list[bytes], length: int = LENGTH):
        self.length = length
        size = np.array([len(s) for s in strings], np.int64)
        self.size, self.offset = size, np.concatenate([[0], np.cumsum(size + 1)[:-1]])
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int64) + 1
        text[self.offset + size] = 0  # the end of a string; bytes are 1 .. 256
        self.text, n = text, len(text)
        order, same = self._sort()
        # intervals of suffixes with equal first length - 1 and length symbols
        self.wide_start, self.wide_end = self._intervals(same(length - 1))
        start = np.flatnonzero(~same(length))
        self.class_start = start
        self.earliest = np.minimum.reduceat(order, start)  # kept per interval of equal windows
        bwt = text[order - 1]
        head = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        self.run_start, self.run_symbol = head, bwt[head]
        lengths = np.diff(np.append(head, n))
        self.run_last = order[np.append(head[1:], n) - 1]  # text positions sampled at the runs' ends
        self.run_first, self.run_end = order[head], np.append(head[1:], n)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(bwt, minlength=258))])[:258]
        # runs of a symbol, in order, with the symbol's count before each
        self.r = len(head) + 1
        by = np.argsort(self.run_symbol, kind="stable")
        self.keys = self.run_symbol[by] * self.r + by
        self.before = np.concatenate([[0], np.cumsum(lengths[by])])
        self.symbol_base = self.before[np.searchsorted(self.keys, np.arange(258) * self.r)]
        self.by = by
        # LF image of every run's start, and a directory from positions to runs
        image = np.empty(len(head), np.int64)
        image[by] = self.before[:-1] - self.symbol_base[self.run_symbol[by]] + self.smaller[self.run_symbol[by]]
        self.run_image = image
        self.run_of = np.repeat(np.arange(len(head), dtype=np.int32), lengths)

    def _sort(self):
        """Suffix order to at least ``length`` symbols by prefix doubling, and a
        test of neighbours for equal prefixes of a given length."""
        text, n = self.text, len(self.text)
        depth, padded = 7, np.concatenate([text, np.zeros(7, np.int64)])
        key = np.zeros(n, np.int64)
        for j in range(7):  # 9 bits a symbol
            key = (key << 9) | padded[j:j + n]
        while True:
            order = np.argsort(key)
            step = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
            rank = np.empty(n, np.int64)
            rank[order] = step
            if 2 * depth >= self.length - 1 and depth < self.length:
                half, half_rank = depth, np.concatenate([rank, np.full(self.length, -1)])
            if depth >= self.length:
                break
            key = (rank << 32) | np.concatenate([rank[depth:] + 1, np.zeros(min(depth, n), np.int64)])[:n]
            depth *= 2

        def same(length: int) -> np.ndarray:
            a, b = half_rank[order], half_rank[order + length - half]
            return np.concatenate([[False], (a[1:] == a[:-1]) & (b[1:] == b[:-1]) & (b[1:] >= 0)])
        return order, same

    @staticmethod
    def _intervals(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start = np.flatnonzero(~same)
        which = np.cumsum(~same) - 1
        return start[which], np.append(start[1:], len(same))[which]

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of ``symbol`` in the BWT before ``at``, and the number of its runs that begin before."""
        run = np.searchsorted(self.run_start, at, side="right") - 1
        k = np.searchsorted(self.keys, symbol * self.r + run)
        inside = np.where(self.run_symbol[run] == symbol, at - self.run_start[run], 0)
        return self.before[k] - self.symbol_base[symbol] + inside, k + (inside > 0)

    def step(self, c: np.ndarray, lo: np.ndarray, hi: np.ndarray, hold: np.ndarray):
        """Backward step: the intervals [lo, hi) extended by the symbols c, each
        of which occurs in its interval, with their toeholds."""
        run = self.run_of[lo]
        low = self.run_image[run] + lo - self.run_start[run]
        high, held = low + hi - lo, hold - 1
        rest = np.flatnonzero(run != self.run_of[hi - 1])  # over several runs: count them
        if len(rest):
            c, lo, hi = c[rest], lo[rest], hi[rest]
            a, _ = self.rank(c, lo)
            b, k = self.rank(c, hi)
            low[rest], high[rest] = self.smaller[c] + a, self.smaller[c] + b
            # toehold: step back from it, or from a sampled end of the interval's last run of c
            last = self.by[k - 1]
            sample = np.where(self.run_end[last] <= hi, self.run_last[last], self.run_first[last])
            held[rest] = np.where(self.text[hold[rest] - 1] == c, hold[rest], sample) - 1
        return low, high, held

    def marked(self) -> list[np.ndarray]:
        """Per string, which of its windows start earlier in the indexed text."""
        length, n = self.length, len(self.text)
        out = [np.zeros(s - length + 1, bool) for s in self.size]
        flat, base = np.zeros(n, bool), self.offset
        self.found = np.full(n, -1)  # by window: where the index has located it
        lo, hi = np.zeros(len(out), np.int64), np.full(len(out), n, np.int64)
        hold = np.full(len(out), self.run_last[-1])  # a text position of the current match
        live = np.argsort(-self.size, kind="stable")  # longest first: the active ones are a prefix
        size = self.size[live]
        lo, hi, hold = lo[live], hi[live], hold[live]
        for i in range(int(size[0]) if len(size) else 0):
            m = int(np.searchsorted(-size, -i, side="left"))  # strings longer than i
            lo, hi, hold = lo[:m], hi[:m], hold[:m]
            at = base[live[:m]] + size[:m] - 1 - i
            c = self.text[at]
            if i >= length:  # slide: drop the last symbol of the match
                lo, hi = self.wide_start[lo], self.wide_end[lo]
            lo, hi, hold = self.step(c, lo, hi, hold)
            if i >= length - 1:
                first = self.earliest[np.searchsorted(self.class_start, lo, side="right") - 1]
                flat[at] = first < at
                self.found[at] = hold
        for j, o in enumerate(self.offset):
            out[j] = flat[o:o + len(out[j])]
        return out


def _groups(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[list[tuple]]:
    """Rows as (bytes of the text, *columns), a bounded number of bytes at a time."""
    group, size = [], 0
    for b in batches:
        for text, *rest in zip(b["text"], *(b[c] for c in columns)):
            raw = text.as_buffer()
            raw = raw.to_pybytes() if raw is not None else b""
            group.append((raw, *rest))
            size += len(raw)
            if size > GROUP:
                yield group
                group, size = [], 0
    if group:
        yield group


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def anchors(rows: DataFrame) -> DataFrame:
    """h, n: occurrences of every anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0

        def flush():
            h, n = np.unique(np.concatenate(kept), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "c"])

        for group in _groups(batches):
            kept.append(stretches([g[0] for g in group])[0])
            size += len(kept[-1])
            if size > 1 << 20:
                yield flush()
                kept, size = [], 0
        if kept:
            yield flush()

    return rows.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("n"))


def _windows(text: bytes, first: int, end: int) -> list[int]:
    """128-bit hashes of the windows of a stretch."""
    return [xxhash.xxh3_128_intdigest(text[i:i + LENGTH]) for i in range(first, end)]


def _halves(h: int) -> tuple[int, int]:
    return _signed(h >> 64), _signed(h & (1 << 64) - 1)


def candidates(rows: DataFrame, repeated: bloom.Bloom, crowded: np.ndarray) -> DataFrame:
    """Stretches of repeated anchors, one of equal ones per task at most (the
    earliest): h, id, row, at, body; and the windows of crowded anchors: k1, k2
    (their hash), id, row, at."""
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"h long, k1 long, k2 long, id {id_type}, row long, at long, body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}  # body, or hash of a window: place and anchor

        def flush():
            window = [isinstance(k, int) for k in best]
            halves = [_halves(k) if w else (None, None) for k, w in zip(best, window)]
            spots = list(best.values())
            arrays = [pa.array([None if w else s[4] for s, w in zip(spots, window)], pa.int64()),
                      pa.array([h[0] for h in halves], pa.int64()), pa.array([h[1] for h in halves], pa.int64()),
                      pa.array([s[1] if s[0] else None for s in spots], id_arrow), pa.array([s[2] for s in spots], pa.int64()),
                      pa.array([s[3] for s in spots], pa.int64()),
                      pa.array([None if w else k for k, w in zip(best, window)], pa.binary())]
            best.clear()
            return pa.RecordBatch.from_arrays(arrays, ["h", "k1", "k2", "id", "row", "at", "body"])

        id_arrow = None
        for group in _groups(batches, "id"):
            id_arrow = group[0][1].type
            texts = [g[0] for g in group]
            joined, base = b"".join(texts), np.cumsum([0, *map(len, texts)])
            h, first, end = stretches(texts)
            hits = repeated.hits(h)
            h, first, end = h[hits], first[hits], end[hits]
            owner = np.searchsorted(base, first, side="right") - 1
            last = -1
            for o, anchor, f, e, crowd in zip(owner.tolist(), h.view(np.int64).tolist(), first.tolist(), end.tolist(),
                                              np.isin(h, crowded).tolist()):
                if o != last:
                    last, start = o, int(base[o])
                    doc_id = group[o][1].as_py()
                    row = _signed(xxhash.xxh64_intdigest(texts[o], 42))  # as Spark's xxhash64
                    known = doc_id is not None
                    doc_id = doc_id if known else 0
                for key, f in (zip(_windows(joined, f, e), range(f, e)) if crowd
                               else ((joined[f:e + LENGTH - 1], f),)):
                    spot = (known, doc_id, row, f - start, anchor)
                    if best.setdefault(key, spot) > spot:
                        best[key] = spot
            if len(best) > COMBINED:
                yield flush()
        if best:
            yield flush()

    return rows.mapInArrow(run, schema)


def firsts(found: DataFrame) -> DataFrame:
    """Per group of an anchor: id, row, at of the earliest copy of every
    stretch, and ``marks``, the bits of its windows that start earlier elsewhere."""
    id_type = found.schema["id"].dataType.simpleString()
    rows = found.filter("h IS NOT NULL").select("h", "id", "row", "at", "body")
    rows = rows.repartition("h").sortWithinPartitions("h", F.col("id").asc_nulls_first(), "row", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spots, marks, group, chunk, size = [], [], {}, [], 0

        def index():
            """Mark the chunk's groups.  An index needs corpus order only inside a group."""
            strings = [s for g in chunk for s in g]
            bits = RunIndex(strings).marked()
            spots.extend(x for g in chunk for x in g.values())
            marks.extend(np.packbits(m).tobytes() if m.any() else None for m in bits)
            chunk.clear()

        def close():
            nonlocal size
            if len(group) == 1:
                spots.extend(group.values())
                marks.append(None)
            elif group:
                chunk.append(dict(group))
                size += sum(map(len, group))
            group.clear()

        def out():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([s[0] for s in spots], b_type), pa.array([s[1] for s in spots], pa.int64()),
                 pa.array([s[2] for s in spots], pa.int64()), pa.array(marks, pa.binary())], ["id", "row", "at", "marks"])
            spots.clear()
            marks.clear()
            return batch

        last, b_type = None, None
        for b in batches:
            b_type = b["id"].type
            for h, *spot, body in zip(*(b[c].to_pylist() for c in ("h", "id", "row", "at", "body"))):
                if h != last:
                    close()
                    last = h
                    if size > CHUNK:
                        index()
                        size = 0
                    if len(spots) > COMBINED:
                        yield out()
                group.setdefault(body, spot)
        close()
        if chunk:
            index()
        if spots:
            yield out()

    return rows.mapInArrow(run, f"id {id_type}, row long, at long, marks binary")


def remove(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, kept (the remaining bytes), n_bytes, n_removed and n_spans
    (maximal removed runs) per row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = cut_lineage(anchors(rows).filter("n > 1"))
    size = counts.agg(F.count("*").alias("n"), F.sum("n").alias("total")).first()
    limit = max(CROWDED, (size.total or 0) >> 16)
    # at most 65,536 anchors can have that many occurrences
    crowded = np.sort(np.array([r.h for r in counts.filter(F.col("n") > limit).select("h").collect()],
                               np.int64).view(np.uint64))
    repeated = bloom.build(counts, size.n, max_bits=1 << 26)
    found = written(candidates(rows, repeated, crowded))
    spot = F.struct(F.col("id").isNotNull().alias("has"), "id", "row", "at")
    windows = found.filter("h IS NULL").groupBy("k1", "k2").agg(F.min(spot).alias("s")) \
        .select("s.id", "s.row", "s.at", F.lit(None).cast("binary").alias("marks"))
    listed = firsts(found).unionByName(windows).groupBy(F.col("id").alias("__id"), F.col("row").alias("__row")) \
        .agg(F.collect_list(F.struct("at", "marks")).alias("listed"))
    whole = rows.withColumn("row", F.xxhash64("text")).join(
        listed, F.col("id").eqNullSafe(F.col("__id")) & (F.col("row") == F.col("__row")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, "id", "listed"):
            texts = [g[0] for g in group]
            gone = covered(texts, [g[2] for g in group], repeated, crowded)
            joined, end, out = np.frombuffer(b"".join(texts), np.uint8), 0, []
            for t in texts:
                at, end = end, end + len(t)
                g = gone[at:end]
                n = int(g.sum())
                spans = int((g[1:] & ~g[:-1]).sum()) + int(g[0]) if n else 0
                out.append((joined[at:end][~g].tobytes() if n else t, len(t), n, spans))
            kept, *counts = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[1].as_py() for g in group], group[0][1].type), pa.array(kept, pa.binary()),
                 *(pa.array(c, pa.int64()) for c in counts)], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return whole.select("id", "text", "listed").mapInArrow(
        run, f"doc_id {rows.schema['id'].dataType.simpleString()}, kept binary, n_bytes long, n_removed long, n_spans long")


def report(docs: DataFrame, **kw) -> DataFrame:
    """The same with the SHA-256 of the kept bytes instead of them."""
    return remove(docs, **kw).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def covered(texts: list[bytes], listed: list, repeated: bloom.Bloom, crowded: np.ndarray) -> np.ndarray:
    """Which bytes of the texts, laid end to end, lie in a window that starts
    earlier elsewhere.  ``listed``: per text its earliest stretches and windows."""
    base = np.cumsum([0, *map(len, texts)])
    h, first, end = stretches(texts)
    hits = repeated.hits(h)
    h, first, end = h[hits], first[hits], end[hits]
    edge = np.zeros(int(base[-1]) + 1, np.int32)
    edge[first] += 1
    edge[end] -= 1
    crowd = np.isin(h, crowded)
    places, marked = [], []
    for start, one in zip(base.tolist(), listed):
        values = one.values
        if values is not None and len(values):
            at = values.field("at").to_numpy() + start
            places.append(at)
            bits = values.field("marks")
            if bits.null_count < len(bits):
                marked += [(a, m) for a, m in zip(at.tolist(), bits.to_pylist()) if m is not None]
    if places:
        at = np.concatenate(places)
        k = np.searchsorted(first, at, side="right") - 1
        # a listed stretch is not removed, nor a listed window of a crowded one
        stop = np.where(crowd[k], at + 1, end[k])
        np.subtract.at(edge, at, 1)
        np.add.at(edge, stop, 1)
    dup = np.cumsum(edge[:-1]) > 0
    for a, m in marked:
        e = int(end[np.searchsorted(first, a)])
        dup[a:e] = np.unpackbits(np.frombuffer(m, np.uint8), count=e - a)
    starts = np.flatnonzero(dup)
    edge = np.zeros(int(base[-1]) + 1, np.int32)
    edge[starts] += 1
    edge[starts + LENGTH] -= 1
    return np.cumsum(edge[:-1]) > 0
