import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsieve.llm import bloom, decontam

from corpus_fixtures import make_docs  # noqa: F401


def tokens(text):
    return re.findall(rb"[^ ]+", decontam.folded(text))


def greedy(item, doc, k):
    """Tiles by definition: look for the longest unmarked match, again and again."""
    a, b, out = [False] * len(item), [False] * len(doc), []
    while True:
        best = None
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and not a[i + n] and not b[d + n]
                       and item[i + n] == doc[d + n]):
                    n += 1
                if n >= k and (best is None or (-n, i, d) < best):
                    best = (-n, i, d)
        if best is None:
            return out
        n, i, d = best
        out.append((i, d, -n))
        for o in range(-n):
            a[i + o] = b[d + o] = True


@pytest.mark.parametrize("seed", range(25))
def test_tiles_equal_definition(seed):
    rnd = random.Random(seed)
    vocab = "abcdefghij"[:rnd.choice([2, 4, 10])]
    item = rnd.choices(vocab, k=rnd.randint(3, 25))
    doc = rnd.choices(vocab, k=rnd.randint(3, 25))
    cut = rnd.randrange(len(item))
    doc[2:2] = item[cut:] + item[:cut]
    seeds = [(i, d) for i in range(len(item) - 2) for d in range(len(doc) - 2) if item[i:i + 3] == doc[d:d + 3]]
    assert decontam.tile(seeds, 3) == greedy(item, doc, 3)


def test_hashes_and_filter():
    text = ("Ab, c!d\n" * 90000) + "x" * 600000 + " tail é"
    words = tokens(text)
    h = decontam.token_hashes(decontam.folded(text))
    assert len(h) == len(words) and len(set(h.tolist())) == len(set(words))
    assert decontam.window_hashes(b"a b", 5).size == 0 and decontam.window_hashes(b"", 1).size == 0


def test_bloom_has_no_false_negatives(spark):
    keys = np.random.default_rng(1).integers(-2**63, 2**63, 5000)
    f = bloom.build(spark.createDataFrame([(int(x),) for x in keys], "h long"), len(keys))
    assert len(f.hits(keys.view(np.uint64))) == len(keys)
    other = np.random.default_rng(2).integers(-2**63, 2**63, 50000).view(np.uint64)
    assert len(f.hits(other)) < 1500
    assert len(bloom.build(spark.createDataFrame([], "h long"), 0).hits(other)) == 0


def test_planted_passages(spark, make_docs):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(4000)]
    items = [(i, " ".join(rnd.choices(vocab, k=30))) for i in range(8)] + [(8, "too short here"), (9, None), (10, "")]
    rows = []
    for i in range(60):
        words = rnd.choices(vocab, k=300)
        t = items[i % 8][1].split()
        if i < 8:
            words[50:50] = t  # verbatim
        elif i < 16:
            words[10:10], words[200:200] = t[12:], t[:12]  # reordered
        elif i < 24:
            words[10:10] = t[:20]  # two thirds: under the threshold
        elif i < 32:
            words[10:10] = [w.upper() + "," for w in t[:27]]  # 0.9, other case and punctuation
        elif i < 40:
            words[5:5] = t[:4] + ["x"] + t[4:8] + ["y"] + t[8:12] + ["z"] + t[12:]  # short tiles do not count: 0.6
        rows.append((i, " ".join(words)))
    rows += [(100, None), (101, ""), (102, "too short here"), (None, items[0][1]), (103, items[1][1] + " " + items[2][1])]
    docs = make_docs(rows).withColumn("item_id", F.lit("clash")).withColumn("seed", F.lit(0))
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontam.matches(docs, bench).collect()}
    want = {(i, i % 8) for i in [*range(16), *range(24, 32)]} | {(None, 0), (103, 1), (103, 2)}
    assert set(got) == want
    for (d, i), r in got.items():
        text = next(t for x, t in rows if x == d)
        tiles = greedy(tokens(items[i][1]), tokens(text), 5)
        assert (r.coverage, r.n_tiles) == (sum(t[2] for t in tiles) / 30, len(tiles))
    left = decontam.clean(docs, bench)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {r[0] for r in rows} - {d for d, _ in want if d is not None}
    assert decontam.matches(make_docs([]), bench).count() == 0
    assert decontam.matches(docs, bench.limit(0)).count() == 0
