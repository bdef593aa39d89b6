import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabsieve.llm import tokenfile as tf

from corpus_fixtures import make_docs  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["", None, "Hello, world!  <|endoftext|> tail<|startoftext|>", "ÉCOLE naïve é Σας x y\x1cz\x85",
         "a.b,c's I'LL don't 1234 ½ ß " * 40, "word " * 70000, "x" * 3000, "\n\t \x0b\x0c\r"]


def expected(rows):
    t, at, out = Tokenizer.from_file(PATH), 0, []
    for doc_id, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_round_trip(spark, make_docs, tmp_path):
    rows = [(3 * i + 1, t) for i, t in enumerate(TEXTS)]
    tf.write(make_docs(rows[::-1]).withColumn("id", F.lit("clash")), str(tmp_path / "a"), PATH)
    got = tf.read_back(spark, str(tmp_path / "a")).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == expected(rows)


def test_null_and_repeated_ids(spark, make_docs, tmp_path):
    rows = [(None, "no id"), (None, None), (5, "b"), (5, "b"), (5, "c d")]
    tf.write(make_docs(rows), str(tmp_path / "a"), PATH)
    got = [tuple(r) for r in tf.read_back(spark, str(tmp_path / "a")).orderBy("start").collect()]
    assert [r[0] for r in got] == [None, None, 5, 5, 5]
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]]
    assert sorted(r[2:] for r in got) == sorted(r[2:] for r in expected(rows))


def test_empty_table(spark, make_docs, tmp_path):
    tf.write(make_docs([]), str(tmp_path / "a"), PATH)
    assert tf.read_back(spark, str(tmp_path / "a")).count() == 0


def test_random_access_and_checksums():
    p = tf.Packer()
    sizes = [10, 3 * tf.FRAME_IDS, 0, 7, tf.FRAME_IDS]
    texts = [np.arange(n, dtype="<u4") * 7 + n for n in sizes]
    for i, ids in enumerate(texts):
        p.add(i, [ids.tobytes()])
    data = p.finish()
    f = tf.TokenFile(io.BytesIO(data))
    assert (f.document(3) == texts[3]).all() and f.frames_read == [3]  # one frame only
    assert all((f.document(k) == t).all() for k, t in enumerate(texts))
    stream = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert stream.startswith(b"".join(t.tobytes() for t in texts))
    bad = bytearray(data)
    bad[-tf.FOOTER.size - 1] ^= 1  # the directory frame's checksum
    with pytest.raises(ValueError):
        tf.TokenFile(io.BytesIO(bytes(bad)))


def test_pieces_equal_the_library(monkeypatch):
    """Random mixtures of the classes that the pattern tells apart, also where
    the cache is small, texts are cut into slices and pieces are long."""
    import random
    from itertools import groupby

    from tabsieve.llm import common
    rnd = random.Random(7)
    parts = ["a", "B", "zz", "é", "É", "e\u0301", "'", "'s", "'S", "'LL", "0", "12", "½", ".", "!!", "<|endoftext|>", "<|EndofText|>",
             "<|", "<", "\u0338", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\x85", "\xa0", "\u3000", "Σας", "中文", "😀", "\x00",
             "_", "-", "’s", "İ", "ﬁ", "٣", "q" * 100, "é" * 70]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 25))) for _ in range(4000)] + ["", None, " ".join(parts * 40)]
    library = Tokenizer.from_file(PATH)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    for cache, group, size in ((tf.CACHE_WORDS, tf.GROUP, common.PIECE), (50, 100, 64)):
        monkeypatch.setattr(tf, "CACHE_WORDS", cache)
        monkeypatch.setattr(tf, "CACHE_PIECES", cache)
        monkeypatch.setattr(tf, "GROUP", group)
        monkeypatch.setattr(common.pieces, "__defaults__", (size,))
        encoder = tf.TextIds(PATH)
        got = [np.frombuffer(b"".join(x for _, x in g), "<u4").tolist() for _, g in groupby(encoder([t and t.encode() for t in texts]), lambda x: x[0])]
        assert got == want
        assert all(len(p) <= tf.CACHED_BYTES for p in [*encoder.young, *encoder.old, *encoder.parts])
        assert len(encoder.young) < cache + 4 * group
