"""Token counts by heap-and-linked-list byte-pair merging.

A text is split by the vocabulary's pattern into pieces; a piece starts as a
doubly linked list of bytes, a heap holds every adjacent pair that has a merge
rank, and the pair of lowest rank (leftmost first) is merged until none is
left.  A piece's count is its symbols minus its merges; no ids are made.

Workers keep the counts of pieces seen lately in a bounded two-generation cache;
pieces longer than ``CACHED_BYTES`` are never kept.  Counting is row-wise: no
shuffle, memory bounded by one Arrow batch plus the cache.

Defined cases: NULL text counts as empty (0 bytes, 0 tokens); an added special
token inside a text counts as one token, as the library does by default; rows
with NULL or repeated ids give one row each; other columns are ignored.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed value: the public byte-level pattern of this vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE_PIECES = 500_000
CACHED_BYTES = 64
SLICE = 1 << 16  # pieces counted at a time


def byte_letters() -> list[str]:
    """The vocabulary's letter for every byte: printable Latin-1 stands for
    itself, the other bytes in ascending order for the letters from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, spare = [], 0x100
    for b in range(256):
        letters.append(chr(b if b in plain else spare))
        spare += b not in plain
    return letters


class Merges:
    """Merge ranks by pair of symbol numbers; symbols 0-255 are the bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        number = {c: b for b, c in enumerate(byte_letters())}
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            merged = number.setdefault(a + b, len(number))
            self.ranks.setdefault((number[a], number[b]), (rank, merged))

    def count(self, piece: bytes) -> int:
        """Symbols minus merges of one piece."""
        n = len(piece)
        symbol = list(piece)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        ranks, merges = self.ranks, 0
        heap = [(r[0], i, r[1], symbol[i], symbol[i + 1]) for i in range(n - 1)
                if (r := ranks.get((symbol[i], symbol[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, merged, a, b = heapq.heappop(heap)
            j = right[i] if symbol[i] == a else n
            if j >= n or symbol[j] != b:
                continue  # one of the two has been merged meanwhile
            merges += 1
            symbol[i], symbol[j] = merged, -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if r := ranks.get((merged, symbol[k])):
                    heapq.heappush(heap, (r[0], i, r[1], merged, symbol[k]))
            if (h := left[i]) >= 0 and (r := ranks.get((symbol[h], merged))):
                heapq.heappush(heap, (r[0], h, r[1], symbol[h], merged))
        return n - merges


class Counter:
    """Token counts of whole texts with a bounded cache of pieces."""

    def __init__(self, path: str, pattern: str = PATTERN):
        self.merges = Merges(path)
        self.findall = regex.compile(pattern).findall
        self.special = regex.compile("|".join(map(regex.escape, self.merges.special))) \
            if self.merges.special else None
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def learn(self, pieces: list[str]) -> dict[str, int]:
        """Counts of ``pieces``; short ones are kept in the young generation."""
        out = {}
        for p in dict.fromkeys(pieces):
            n = self.young.get(p) or self.old.get(p) or self.merges.count(p.encode("utf-8", "replace"))
            out[p] = n
            if len(p) <= CACHED_BYTES:
                self.young[p] = n
        return out

    def plain(self, text: str) -> int:
        total, pieces = 0, self.findall(text)
        for i in range(0, len(pieces), SLICE):
            part = pieces[i:i + SLICE]
            counts = list(map(self.young.get, part))
            if None in counts:
                counts = map(self.learn(part).__getitem__, part)
            total += sum(counts)
            if len(self.young) > CACHE_PIECES:
                self.old, self.young = self.young, {}
        return total

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None or not any(s in text for s in self.merges.special):
            return self.plain(text)
        parts = self.special.split(text)
        return sum(map(self.plain, parts)) + len(parts) - 1


@functools.cache
def shared(path: str) -> Counter:
    """The Python worker's counter, so that its next tasks find its cache filled."""
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) per document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = shared(tokenizer_path)
        for b in batches:
            n = [counter(t.as_py()) for t in b["text"]]
            size = pa.compute.fill_null(pa.compute.binary_length(b["text"]), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], size, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long, over_limit boolean")
