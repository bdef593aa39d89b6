"""Token-ID files: independent zstandard frames, a trailing seek table with
per-frame checksums, and a directory of the documents inside.

File layout (the public zstd *seekable format*, so any zstd reader can also
stream the file front to back)::

    data frame 0 .. n-1   FRAME_IDS little-endian uint32 ids each (the last: fewer)
    directory frame       per document: int64 id, uint8 present, uint64 count
    skippable frame       seek table: per frame compressed size, raw size,
                          low 32 bits of XXH64(raw); count, flags, magic

Every frame is compressed on its own, so :class:`TokenFile` reads the trailer
and the directory and then only the frames that hold the requested document.

Documents are range partitioned and sorted by id; each task packs its range
into files of a bounded size.  Files are committed by Spark's own file writer
(one row per file), so task retries, speculative copies and lost executors
cannot leave partial files, and any store that Spark can write works.
"""

from __future__ import annotations

import functools
import io
import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pieces

# fixed values of the zstd seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_IDS = 1 << 16
FILE_BYTES = 48 << 20  # compressed size after which a task starts its next file
CACHE_WORDS, CACHE_PIECES = 400_000, 300_000  # of at most CACHED_BYTES: 1,100,000 entries in all, some 150 MB
CACHED_BYTES = 64
SEAM = b"\x07"  # a piece of its own between others
GROUP = 1 << 13  # words looked up before the library is asked for the missing ones: few enough to stay in the processor's cache
# fixed value: the vocabulary's pattern, over lower-cased bytes of ASCII
ASCII_PIECE = re.compile(rb"[a-z]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^\sA-Za-z0-9\x80-\xff]+")
# pieces that need no normalisation: small letters, composed ones of Latin-1 among them; a digit; a contraction; signs
PLAIN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[!-/:-@\[-`{-~]+")
# between an ASCII letter and a sign other than the apostrophe, and around digits, pieces always end
SIGN = rb"[^\sa-z0-9'\x80-\xff]"
SAFE_CUT = re.compile(rb"(?<=[a-z])(?=" + SIGN + rb")|(?<=" + SIGN + rb")(?=[a-z])|(?<=[0-9])|(?=[0-9])")
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<III")


class Cache(dict):
    """Ids by word; words asked for that it lacks are noted in ``missing``."""

    def __init__(self):
        super().__init__()
        self.missing: list[bytes] = []

    def __missing__(self, word: bytes) -> None:
        self.missing.append(word)


class TextIds:
    """Ids of whole texts, by way of bounded caches of encoded words and pieces.

    The tokenizer lower-cases, drops white space and never merges across the
    pieces its pattern cuts, so a text's ids are its lower-cased words' ids in
    order, and a word's those of its pieces.  Words not seen lately are cut where
    the pattern must cut (a word with bytes beyond ASCII, whose classes are the
    library's matter, only between ASCII letters, digits and signs), and pieces not
    seen lately go through the library, those of many texts in one call.  A slice of
    text that holds an added token's string, in any case, goes through it whole.

    The words' cache has two generations of ``CACHE_WORDS``: when the young one is
    full it becomes the old one; the pieces' starts anew after ``CACHE_PIECES``.
    Neither keeps anything over ``CACHED_BYTES``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)  # for pieces that are cut and lower-cased already
        self.bare.normalizer = normalizers.Sequence([])
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.seam = self.tokenizer.encode(SEAM.decode(), add_special_tokens=False).ids
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a piece
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        added = [t.content.encode().lower() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile(b"|".join(map(re.escape, added)) or rb"(?!)")
        self.hint = os.path.commonprefix(added)  # found faster than the whole of them
        self.young, self.old = Cache(), Cache()
        self.parts: dict[bytes, bytes] = {}

    def encoded(self, found: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct lower-cased pieces by the library: plain ones as one text, each ending
        where an id ends a piece; others as one text too, with a piece that none
        of them holds in between; what is left one by one."""
        plain, mixed, rest = [], [], []
        for p in found:
            (plain if PLAIN.fullmatch(p) else rest if SEAM in p or self.hint in p else mixed).append(p)
        out = {}
        if plain:
            ids = np.array(self.bare.encode_batch_fast([b" ".join(plain).decode()], add_special_tokens=False)[0].ids, "<u4")
            end = np.flatnonzero(self.ends[ids]) + 1
            if len(end) != len(plain):
                raise ValueError("the vocabulary does not end pieces where its pattern does")
            raw, at = ids.tobytes(), 0
            for p, e in zip(plain, (4 * end).tolist()):
                out[p], at = raw[at:e], e
        if mixed and len(self.seam) == 1:
            text = (b" " + SEAM + b" ").join(mixed).decode("utf-8", "replace")
            ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            end = np.flatnonzero(ids == self.seam[0])
            if len(end) == len(mixed) - 1:
                raw, at = ids.tobytes(), 0
                for p, e in zip(mixed, [*(4 * end).tolist(), len(raw)]):
                    out[p], at = raw[at:e], e + 4
                mixed = []
        rest += mixed
        if rest:
            encodings = self.tokenizer.encode_batch_fast([p.decode("utf-8", "replace") for p in rest],
                                                         add_special_tokens=False)
            out.update((p, array("I", e.ids).tobytes()) for p, e in zip(rest, encodings))
        return out

    def learn(self, missing: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of words that the young generation lacks; short ones enter it."""
        out, cuts, new = {}, {}, {}
        for w in dict.fromkeys(missing):
            ids = self.old.get(w)  # does not note it
            if ids is None:
                cuts[w] = found = ASCII_PIECE.findall(w) if w.isascii() else [p for p in SAFE_CUT.split(w) if p]
                for p in found:
                    if p not in self.parts:
                        new[p] = None
            else:
                out[w] = ids
        new = self.encoded(list(new))
        parts = self.parts
        for w, found in cuts.items():
            out[w] = b"".join([new[p] if p in new else parts[p] for p in found])
        if len(parts) > CACHE_PIECES:
            parts.clear()
        parts.update((p, ids) for p, ids in new.items() if len(p) <= CACHED_BYTES)
        self.young.update((w, ids) for w, ids in out.items() if len(w) <= CACHED_BYTES)
        return out

    def __call__(self, texts: Iterable[bytes | None]) -> Iterator[tuple[int, bytes]]:
        """UTF-8 texts -> (number of the text, little-endian uint32 ids) in order; a long text
        comes in several slices, an empty one in one."""
        group, held = [], 0

        def flush() -> Iterator[tuple[int, bytes]]:
            extra = self.learn(self.young.missing) if self.young.missing else {}
            self.young.missing.clear()
            for i, found, ids in group:
                if found is not None:
                    ids = [x if x is not None else extra[w] for w, x in zip(found, ids)]
                yield i, b"".join(ids)
            if len(self.young) > CACHE_WORDS:
                self.old, self.young = self.young, Cache()

        for i, text in enumerate(texts):
            for data in pieces(text or b""):
                low = data.lower()
                if self.hint in low and self.added.search(low):
                    found = self.tokenizer.encode(data.decode("utf-8", "replace"), add_special_tokens=False)
                    group.append((i, None, [array("I", found.ids).tobytes()]))
                    continue
                found, known = low.split(), len(self.young.missing)
                ids = list(map(self.young.__getitem__, found))
                group.append((i, found if len(self.young.missing) > known else None, ids))
                held += len(found)
                if held >= GROUP:
                    yield from flush()
                    group, held = [], 0
        yield from flush()


@functools.cache
def shared(path: str) -> TextIds:
    """The Python worker's encoder, so that its next tasks find its cache filled."""
    return TextIds(path)


class Packer:
    """Builds one file; ``add`` documents in order, then ``finish``."""

    def __init__(self, level: int = 3):
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.frames: list[bytes] = []
        self.table: list[tuple[int, int, int]] = []
        self.rest = bytearray()
        self.ids: list[int] = []
        self.present: list[bool] = []
        self.counts: list[int] = []
        self.size = 0

    def frame(self, raw: bytes) -> None:
        packed = self.zstd.compress(raw)
        self.frames.append(packed)
        self.table.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.size += len(packed)

    def add(self, doc_id: int | None, pieces: Iterable[bytes]) -> None:
        """Append one document, given its ids as little-endian uint32 bytes."""
        n = 0
        for raw in pieces:
            n += len(raw) // 4
            self.rest += raw
            while len(self.rest) >= 4 * FRAME_IDS:
                self.frame(bytes(self.rest[:4 * FRAME_IDS]))
                del self.rest[:4 * FRAME_IDS]
        self.ids.append(doc_id or 0)
        self.present.append(doc_id is not None)
        self.counts.append(n)

    def finish(self) -> bytes:
        if self.rest:
            self.frame(bytes(self.rest))
        self.frame(np.array(self.ids, "<i8").tobytes() + np.array(self.present, "u1").tobytes()
                   + np.array(self.counts, "<u8").tobytes())
        body = b"".join(ENTRY.pack(*e) for e in self.table) \
            + FOOTER.pack(len(self.table), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


class TokenFile:
    """Random access to one file through any object with ``seek`` and ``read``.
    ``frames_read`` lists the data frames decompressed so far."""

    def __init__(self, f):
        self.f, self.frames_read, self.last = f, [], (-1, b"")
        f.seek(-FOOTER.size, io.SEEK_END)
        n, flags, magic = FOOTER.unpack(f.read(FOOTER.size))
        if magic != SEEKABLE_MAGIC or not flags & CHECKSUM_FLAG:
            raise ValueError("not a token file: no seek table with checksums")
        f.seek(-FOOTER.size - n * ENTRY.size, io.SEEK_END)
        self.table = list(ENTRY.iter_unpack(f.read(n * ENTRY.size)))
        self.at = np.concatenate([[0], np.cumsum([e[0] for e in self.table])]).tolist()
        raw = self.frame(n - 1)
        k = len(raw) // 17
        self.ids = np.frombuffer(raw, "<i8", k)
        self.present = np.frombuffer(raw, "u1", k, 8 * k).astype(bool)
        self.counts = np.frombuffer(raw, "<u8", k, 9 * k).astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.counts)])

    def frame(self, i: int) -> bytes:
        if self.last[0] != i:
            packed, size, check = self.table[i]
            self.f.seek(self.at[i])
            raw = zstandard.ZstdDecompressor().decompress(self.f.read(packed), max_output_size=size)
            if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
                raise ValueError(f"frame {i}: checksum differs")
            if i < len(self.table) - 1:
                self.frames_read.append(i)
            self.last = (i, raw)
        return self.last[1]

    def pieces(self, k: int) -> Iterator[bytes]:
        """Raw id bytes of the k-th document, frame by frame."""
        a, b = int(self.starts[k]), int(self.starts[k + 1])
        while a < b:
            i, off = divmod(a, FRAME_IDS)
            n = min(b - a, FRAME_IDS - off)
            yield self.frame(i)[4 * off:4 * (off + n)]
            a += n

    def document(self, k: int) -> np.ndarray:
        return np.frombuffer(b"".join(self.pieces(k)), "<u4")


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2,
          id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode every text (NULL: empty), append ``end_id``, and write the files
    under ``path`` in ascending id order: file names sort like the ids inside.

    NULL ids come first; rows sharing an id are all written, next to each
    other, ordered by a hash of the text (so that a much repeated id spreads
    over tasks).  An empty table writes no file.  Other columns are ignored."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    order = [F.col("id").asc_nulls_first(), F.col("tie")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, out = shared(tokenizer_path), None
        end = struct.pack("<I", end_id)

        def file(p: Packer) -> pa.RecordBatch:
            # the writer ends each file with its separator: the magic's four bytes
            return pa.RecordBatch.from_arrays([pa.array([p.finish()[:-4]], pa.binary())], ["content"])

        for batch in batches:
            doc_ids = batch["id"].to_pylist()
            for i, parts in groupby(ids(batch["text"].cast(pa.binary()).to_pylist()), itemgetter(0)):
                out = out or Packer()
                out.add(doc_ids[i], chain(map(itemgetter(1), parts), [end]))
                if out.size >= FILE_BYTES:
                    yield file(out)
                    out = None
        if out:
            yield file(out)

    files = rows.select("id", "text").mapInArrow(pack, "content binary")
    files.select(F.col("content").cast("string").alias("value")).write \
        .option("lineSep", struct.pack("<I", SEEKABLE_MAGIC).decode("latin-1")) \
        .option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(path)


READ_SCHEMA = "path string, k long, doc_id long, n_tokens long, ids_crc32 long"


def read_back(spark: SparkSession, path: str,
              digest: Callable[[Iterable[bytes]], int] | None = None) -> DataFrame:
    """One row per document in the files under ``path``: doc_id, start (ids of
    all documents before it), n_tokens and a digest of its ids (crc32)."""
    digest = digest or crc32

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                data = content.as_buffer()
                if data.size == 0:
                    continue
                f = TokenFile(pa.BufferReader(data))
                n = len(f.ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([name.as_py()] * n, pa.string()), pa.array(range(n), pa.int64()),
                    pa.array(f.ids, pa.int64(), mask=~f.present), pa.array(f.counts, pa.int64()),
                    pa.array([digest(f.pieces(k)) for k in range(n)], pa.int64())],
                    ["path", "k", "doc_id", "n_tokens", "ids_crc32"])

    found = spark.read.format("binaryFile").load(path).select("path", "content") \
        .mapInArrow(unpack, READ_SCHEMA)
    # file order: task number, then the task's file number
    found = found.withColumn("part", F.regexp_extract("path", r"part-(\d+)-", 1).cast("long")) \
        .withColumn("file", F.regexp_extract("path", r"-c(\d+)\.", 1).cast("long"))
    inside = Window.partitionBy("part", "file").orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    files = found.groupBy("part", "file").agg(F.sum("n_tokens").alias("total"))  # a row per file
    files = files.select("part", "file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return found.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))) \
        .join(files, ["part", "file"]) \
        .select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def crc32(pieces: Iterable[bytes]) -> int:
    """CRC-32 of the concatenated pieces."""
    out = 0
    for p in pieces:
        out = zlib.crc32(p, out)
    return out
