import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsieve.llm import balltree

from corpus_fixtures import make_docs  # noqa: F401


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    tf = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(tf), sum(sum(c.values()) for _, c in tf)
    df = Counter(t for _, c in tf for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        scored = []
        for doc_id, c in tf:
            m = 25 + 75 * sum(c.values()) * n_docs // n_terms
            scored.append((-sum(w[t] * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if t in c), doc_id))
        out += [(item, r + 1, d, -s) for r, (s, d) in enumerate(sorted(x for x in scored if x[0])[:k])]
    return sorted(out)


def corpus(n=700, seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"{rnd.choice('ABcdé')}{i}" for i in range(400)]
    docs = [(i * 3, " ".join(vocabulary[min(int(rnd.expovariate(0.02)), 399)] for _ in range(rnd.randint(0, 60)))) for i in range(n)]
    docs += [(5000 + i, docs[7][1]) for i in range(30)]  # ties
    items = [(i, " ".join(rnd.sample(vocabulary, 8)) + " " + docs[i][1][:90]) for i in range(25)]
    return docs, items


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block, tree", [(balltree.BLOCK, balltree.TREE), (40, 64)])
def test_against_brute_force(spark, make_docs, monkeypatch, block, tree):
    monkeypatch.setattr(balltree, "TREE", tree)
    docs, items = corpus()
    docs += [(9001, None), (9002, " .,"), (9003, "x" * 300000 + " B3 " * 40000)]
    items += [(800, None), (801, "unknownword"), (802, ""), (803, "É é A1 a1 a1 b2")]
    got = balltree.search(make_docs(docs), bench(spark, items), block=block)
    assert sorted(tuple(r)[:4] for r in got.collect()) == brute(docs, items)


def test_bounds_hold_and_prune():
    rnd = np.random.default_rng(3)
    dims, n = 300, 3000
    topic = rnd.integers(0, 30, n)
    rows = [np.unique(np.concatenate([rnd.integers(0, dims, 3), topic[i] * 10 + rnd.integers(0, 10, 12)])) for i in range(n)]
    ptr = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    col = np.concatenate(rows)
    val = rnd.integers(1, 3 * 10 ** 10, len(col))
    tree = balltree.BallTree(list(range(n)), ptr, col, val, dims)
    full = np.zeros((n, dims), np.int64)
    full[np.repeat(np.arange(n), np.diff(ptr)), col] = val
    place = {d: i for i, d in enumerate(tree.ids)}
    opened, leaves = [], sum(k < 0 for k, _ in tree.kids)
    for t in range(30):
        q = np.unique(t * 10 + rnd.integers(0, 10, 6))
        counts = rnd.integers(1, 5, len(q))
        scores = full[:, q] @ counts
        bound = tree.bounds(q, counts)
        for node, (a, b) in enumerate(tree.span):
            assert a == b or scores[tree.ids[a:b]].max() <= bound[node]
        best = []
        opened.append(tree.search(q, counts, np.zeros(dims, np.int64), best, 10))
        want = sorted(((int(s), True, -i) for i, s in enumerate(scores)), reverse=True)[:10]
        assert sorted(best, reverse=True) == want
        # a parent's bound covers its documents too
        for node, (x, y) in enumerate(tree.kids):
            if x < 0:
                a, b = tree.span[node]
                assert sorted(place[i] for i in tree.ids[a:b]) == list(range(a, b))
    assert np.mean(opened) < leaves * 3 / 4


def test_equal_documents_and_rounding():
    """All points equal: radius is rounding only, and the bound still holds."""
    n, dims = 500, 4
    col, val = np.tile([0, 3], n), np.tile([29_999_999_999, 3], n)
    tree = balltree.BallTree(list(range(n)), np.arange(0, 2 * n + 1, 2), col, val, dims)
    best = []
    tree.search(np.array([0]), np.array([7]), np.zeros(dims, np.int64), best, 10)
    assert sorted(-neg for _, _, neg in best) == list(range(10)) and best[0][0] == 7 * 29_999_999_999


def test_nulls_repeats_clashes_and_empty(spark, make_docs):
    docs = make_docs([(None, "apple pie"), (4, "apple pie"), (4, "apple pie"), (2, "Apple"), (9, None)])
    odd = docs.select("*", F.lit(1).alias("n"), F.lit("q").alias("Text"), F.lit(2).alias("score"), F.lit(3).alias("DOC_ID"))
    items = bench(spark, [(1, "apple pie"), (1, "apple pie"), (1, "pie"), (None, "apple")]).select("*", F.lit(0).alias("Item_Id"))
    got = [tuple(r)[:3] for r in balltree.search(odd, items).orderBy("item_id", F.col("item"), "rank").collect()]
    assert sorted(g for g in got if g[0] is None) == sorted((None, i + 1, d) for i, d in enumerate([2, 4, 4, None]))
    assert len(got) == 4 + 4 + 3
    assert balltree.search(docs.limit(0), items).count() == 0
    assert balltree.search(docs, items.limit(0)).count() == 0
    assert balltree.search(docs, bench(spark, [(1, None)])).count() == 0
