import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabsieve.llm import simhash
from tabsieve.llm.components import components

from corpus_fixtures import make_docs  # noqa: F401


def brute_print(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def brute_roots(n, linked):
    root = list(range(n))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(n)]


def test_fingerprints(spark, make_docs):
    texts = ["", None, " \n", "One", "One TWO", "a B c", "É Ü x y z\x85w q", "w " * 100000, "a b c d e f g " * 9,
             " ".join(map(str, range(5000)))]
    got = {r.doc_id: r.fp & (2**64 - 1) for r in simhash.fingerprints(make_docs(list(enumerate(texts)))).collect()}
    assert got == {i: brute_print(t) for i, t in enumerate(texts)}
    hashed = spark.createDataFrame([("a b c",)], "s string").select(F.xxhash64("s")).first()[0]
    assert hashed & (2**64 - 1) == xxhash.xxh64_intdigest(b"a b c", 42)


def test_code_is_perfect():
    g = simhash.Golay()
    x = np.arange(1 << 23, dtype=np.uint32)
    word = x ^ g.leader[g.remainder(x)]
    assert (g.remainder(word) == 0).all() and np.bitwise_count(word ^ x).max() == 3
    assert len(np.unique(g.index(x))) == 4096
    sizes = (g.near(x[::97], 23) >= 0).sum(1)
    assert set(sizes) == {1, 6}


def test_near_prints_share_a_key():
    rnd, g = random.Random(1), simhash.Golay()
    for _ in range(400):
        x = rnd.getrandbits(64)
        y = x
        for b in rnd.sample(range(64), rnd.randint(0, 3)):
            y ^= 1 << b
        own = simhash.own_keys(np.array([y], np.uint64), g)[0]
        assert set(own) & set(simhash.near_keys(np.array([x], np.uint64), g)[1])


def test_links_equal_brute_force(spark):
    rnd = random.Random(7)
    prints = []
    for _ in range(60):
        base = rnd.getrandbits(64)
        for _ in range(12):
            x = base
            for b in rnd.sample(range(64), rnd.randint(0, 4)):
                x ^= 1 << b
            prints.append(x)
    prints = sorted(set(prints) | {0, 1, 2**64 - 1})
    df = spark.createDataFrame([(x - 2**64 if x >> 63 else x,) for x in prints] + [(None,)], "fp long")
    got = {tuple(sorted((r.x & (2**64 - 1), r.y & (2**64 - 1)))) for r in simhash.links(df).collect()}
    assert got == {(a, b) for i, b in enumerate(prints) for a in prints[:i] if (a ^ b).bit_count() <= 3}


def test_groups(spark, make_docs):
    rnd = random.Random(3)
    rows, vocab = [], [f"w{i}" for i in range(300)]
    for k in range(12):
        words = rnd.choices(vocab, k=400)
        for c in range(5):
            w = list(words)
            for _ in range(c // 2):
                w[rnd.randrange(400)] = "changed"
            rows.append((1000 - 7 * len(rows), " ".join(w)))
    rows += [(5000, ""), (4999, None), (4998, "  \t")]
    docs = make_docs(rows).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(0))
    got = {r.doc_id: r for r in simhash.groups(docs).collect()}
    prints = [brute_print(t) for _, t in rows]
    roots = brute_roots(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    least = {}
    for (i, _), r in zip(rows, roots):
        least[r] = min(least.get(r, i), i)
    for (i, _), r, p in zip(rows, roots, prints):
        assert (got[i].fingerprint, got[i].component_id) == (f"{p:016x}", least[r])
        assert got[i].n_links == len({q for q in prints if 0 < (q ^ p).bit_count() <= 3})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(least.values())


def test_nulls_repeats_empty(make_docs):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "only here x"), (9, None)]
    got = sorted(map(str, ((r.doc_id, r.component_id, r.n_copies) for r in simhash.groups(make_docs(rows)).collect())))
    assert got == sorted(map(str, [(None, 3, 3), (3, 3, 3), (3, 3, 3), (None, None, 1), (9, 9, 1)]))
    assert simhash.groups(make_docs([])).count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(150)] + [(i, i + 1) for i in range(400, 460)]
    pairs += [(500, i) for i in range(501, 560)] + [(4, 4), (None, 5)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    real = {(a, b) for a, b in pairs if a is not None and a != b}
    roots = brute_roots(600, lambda i, j: (i, j) in real or (j, i) in real)
    assert got == {n: roots[n] for p in real for n in p}
