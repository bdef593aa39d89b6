import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsieve.llm import debruijn

from corpus_fixtures import make_docs  # noqa: F401


def brute(docs, k):
    """doc_id -> (n_words, n_removed, sha) with ids unique or NULL (least)."""
    key = lambda i: -1 if i is None else i
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    least = {}
    for i, w in words:
        for p in range(len(w) - k + 1):
            g = tuple(w[p:p + k])
            least[g] = min(least.get(g, 1 << 60), key(i))
    out = []
    for i, w in words:
        gone = {q for p in range(len(w) - k + 1) if least[tuple(w[p:p + k])] < key(i) for q in range(p, p + k)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=lambda r: (key(r[0]), r))


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (-1 if r[0] is None else r[0], r))


def corpus(seed, n=60, k=8):
    """Random texts with passages copied, edited, nested, overlapping and repeated inside a document."""
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(500)}"
    pool = [[word() for _ in range(rnd.randint(k - 2, 6 * k))] for _ in range(12)]
    texts = []
    for _ in range(n):
        t = []
        for _ in range(rnd.randint(0, 5)):
            p = list(rnd.choice(pool))
            a, b = sorted((rnd.randrange(len(p)), rnd.randrange(len(p))))
            kind = rnd.random()
            t += p if kind < 0.3 else p[a:b + 1] if kind < 0.6 else p[:a] + [word()] + p[a:] if kind < 0.8 else [word() for _ in p]
            t += [word() for _ in range(rnd.choice([0, 0, 1, 5]))]
        texts.append(rnd.choice([" ", "\n", "  \t"]).join(t))
    texts += [texts[3], texts[5] + " end", "the " * 3 * k, "the " * 4 * k, ("a b " * 2 * k).strip(), "x a b " + "a b " * k]
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, make_docs, seed):
    docs = corpus(seed) + [(900, None), (901, ""), (902, " \n ")]
    assert result(debruijn.report(make_docs(docs), k=8)) == brute(docs, 8)


def test_production_window_and_long_text(spark, make_docs):
    rnd = random.Random(8)
    word = lambda: f"w{rnd.randrange(5000)}"
    base = [word() for _ in range(30000)]
    edited = list(base)
    for _ in range(300):
        edited[rnd.randrange(len(base))] = "edit"
    docs = [(1, " ".join(base)), (2, " ".join(edited)), (3, " ".join(base[100:149])), (4, " ".join(base[100:150])),
            (5, " ".join(base[7:57] + base[40:100])), (6, "n" * 400000), (7, "n" * 400000 + " m" * 60), (8, "m " * 70)]
    assert result(debruijn.report(make_docs(docs))) == brute(docs, 50)


def test_slices_of_a_text_do_not_matter(spark, make_docs):
    docs = corpus(4, n=30)
    assert result(debruijn.report(make_docs(docs), k=8, step=11)) == brute(docs, 8)
    h = debruijn.word_hashes(docs[-3][1] + " " + docs[3][1])
    for step in (5, 1 << 18):
        covered = [w for start, size, *_ in debruijn.paths_of(h, 8, step) for s, n in zip(start.tolist(), size.tolist())
                   for w in range(s, s + n)]
        assert covered == list(range(len(h) - 7))


def test_equal_windows_share_anchor_and_place():
    rnd = np.random.default_rng(1)
    same = rnd.integers(0, 2 ** 63, 50).astype(np.uint64)
    found = []
    for pad in (0, 13, 200):
        h = np.concatenate([rnd.integers(0, 2 ** 63, pad).astype(np.uint64), same, rnd.integers(0, 2 ** 63, 30).astype(np.uint64)])
        start, size, anchor, *_ = map(np.concatenate, zip(*debruijn.paths_of(h)))
        found.append(anchor[np.searchsorted(start, pad, "right") - 1])
    assert len(set(found)) == 1


def test_compaction_glues_unbranched_paths(spark, make_docs):
    """One long passage in many documents is one long path, not one per anchor."""
    rnd = random.Random(2)
    passage = " ".join(f"p{rnd.randrange(10 ** 6)}" for _ in range(1000))
    docs = make_docs([(i, f"x{i} {passage} y{i}") for i in range(20)])
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("row"))
    spans = debruijn.repeated(rows).collect()
    assert len(spans) < 19 * 12  # the paths at the ends branch, the inner ones (about 25) are glued
    assert max(s["size"] for s in spans) > 850 and {s.source.id for s in spans} == {0}


def test_forged_hashes_are_caught(spark, make_docs, monkeypatch):
    """Where hashes say equal and words differ, the digest keeps the words."""
    docs = make_docs([(1, " ".join(f"a{i}" for i in range(60))), (2, " ".join(f"b{i}" for i in range(60)))])
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.xxhash64("text").alias("row"))
    one, two = rows.filter("id = 1").first(), rows.filter("id = 2").first()
    schema = "id long, row long, pos int, size int, source struct<id: long, row: long, pos: int>"
    monkeypatch.setattr(debruijn, "repeated", lambda rows, k, step: spark.createDataFrame(
        [(2, two.row, 0, 11, (1, one.row, 0))], schema))
    assert [r.n_removed for r in debruijn.cut(rows).collect()] == [0, 0]


def test_nulls_repeats_clashes_and_empty(spark, make_docs):
    t = " ".join(f"w{i}" for i in range(60))
    docs = make_docs([(None, t), (None, t + " more"), (3, t), (3, t), (3, t + " x"), (4, "a " + t)])
    got = result(debruijn.report(docs))
    assert [g[:3] for g in got] == [(None, 60, 0), (None, 61, 0), (3, 60, 60), (3, 60, 60), (3, 61, 60), (4, 61, 60)]
    twice = make_docs([(3, t), (3, t), (3, t + " x")])
    assert {g[2] for g in result(debruijn.report(twice))} == {0}
    names = ["id", "row", "spans", "TEXT", "n_words", "rest", "Doc_Id", "pos"]
    odd = docs.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    out = debruijn.dedup(odd)
    assert out.columns == odd.columns
    plain = out.toDF(*[f"c{i}" for i in range(len(out.columns))]).collect()
    assert sorted(r.c1 for r in plain) == ["", "", "a", t, t + " more", "x"]
    assert {tuple(r)[5:] for r in plain} == {tuple(range(len(names)))}
    assert debruijn.report(docs.limit(0)).count() == 0
