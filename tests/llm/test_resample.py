import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tabsieve.llm import resample

from corpus_fixtures import make_docs  # noqa: F401


def runs_of(text, n_max=3):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) for n in range(1, n_max + 1) for i in range(len(w) - n + 1)]


def brute(docs, target):
    """doc_id -> (n_features, weight, score, rank)."""
    s, t, found = Counter(), Counter(), {}
    for text in target:
        t.update(c % 10000 for c in runs_of(text)[1])
    for doc_id, text in docs:
        n, crcs = runs_of(text)
        found[doc_id] = n, [c % 10000 for c in crcs]
        s.update(found[doc_id][1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, (n, buckets) in found.items():
        h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in buckets)
        rows.append((n >= 20, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), doc_id, len(buckets), weight))
    able = sorted((r for r in rows if r[0]), key=lambda r: (-r[1], r[2]))
    rank = {r[2]: i + 1 for i, r in enumerate(able[:5 * len(able) // 100])}
    return {r[2]: (r[3], r[4], r[1], rank.get(r[2])) for r in rows}


def texts(n, seed=5):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choices("abcdeé0", k=rnd.randint(1, 9))) for _ in range(300)]
    return [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 80))) for _ in range(n)]


def test_shift_appends_zero_bytes():
    rnd = random.Random(2)
    for size in [0, 1, 3, 63, 64, 65, 127, 5000, 70001]:
        a, b = rnd.randbytes(9), rnd.randbytes(size)
        moved = resample.shift(np.array([zlib.crc32(a)], np.uint32), np.array([size]))
        assert zlib.crc32(a + b) ^ int(moved[0]) == zlib.crc32(b)


def test_runs_equal_crc_of_their_bytes(monkeypatch):
    some = ["", None, " ,.", "A b", "É x  ö1 " + "q" * 5000, "x", "a\x00b\x7fc", "w " * 3000] + texts(150)
    for step in (7, resample.STEP):
        monkeypatch.setattr(resample, "STEP", step)
        pairs = [resample.running(t) for t in some]
        got = [[] for _ in some]
        for doc, crc in resample.runs([c for c, _ in pairs], [s for _, s in pairs]):
            for d, c in zip(doc.tolist(), crc.tolist()):
                got[d].append(c)
        assert [sorted(g) for g in got] == [sorted(runs_of(t)[1]) for t in some]


def test_long_text_in_pieces(monkeypatch):
    from tabsieve.llm import common
    text = " ".join(texts(200)) + " " + "z" * 70000 + " tail"
    whole = resample.running(text)
    monkeypatch.setattr(common.pieces, "__defaults__", (1000,))
    assert resample.running(text) == whole


def test_against_brute_force(spark, make_docs):
    docs = [*enumerate(texts(400)), (900, None), (901, ""), (902, "Only Five Words In Here")]
    target = texts(12, seed=9) + [None, ""]
    bench = spark.createDataFrame(list(enumerate(target)), "item_id long, text string")
    rows = resample.resample(make_docs(docs), bench).collect()
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in rows} == brute(docs, target)
    assert sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 1 + sum(len(t.split()) >= 20 for _, t in docs if t) // 20))


def test_draw_favours_the_target(spark, make_docs):
    rnd = random.Random(4)
    wanted, other = [[f"{p}{i}" for i in range(200)] for p in "ab"]
    docs = [(i, " ".join(rnd.choices(wanted if i < 60 else other, k=30))) for i in range(1200)]
    bench = spark.createDataFrame([(0, " ".join(rnd.choices(wanted, k=3000)))], "item_id long, text string")
    drawn = resample.draw(make_docs(docs).withColumn("rank", F.lit("kept")), bench)
    assert drawn.columns[-1] == "rank"
    ids = [r.doc_id for r in drawn.collect()]
    assert len(ids) == 60 and sum(i < 60 for i in ids) >= 57


def test_nulls_repeats_clashes_and_empty(spark, make_docs):
    long = " ".join(f"w{i}" for i in range(40))
    docs = make_docs([(None, long), (None, None), (1, long), (1, long), (1, "other"), (2, long)])
    odd = docs.select("*", F.lit(1).alias("score"), F.lit(2).alias("TEXT"), F.lit(3).alias("rank"), F.lit(4).alias("low"),
                      F.lit("x").alias("Doc_Id"), F.lit(5).alias("crcs"))
    bench = spark.createDataFrame([(0, long)], "item_id long, text string")
    got = [tuple(r) for r in resample.resample(odd, bench, share=(1, 2)).collect()]
    assert len(got) == 6 and {g[4] for g in got} == {None, 1, 2}
    assert {g[:3] for g in got if g[0] == 1 and g[1] > 1} == {next(g[:3] for g in got if g[0] == 2)[:0] + (1,) + next(
        g[1:3] for g in got if g[0] == 2)}
    assert resample.resample(docs.limit(0), bench).count() == 0
    none = resample.resample(docs, bench.limit(0))
    assert none.count() == 6 and set(none.columns) == {"doc_id", "n_features", "weight", "score", "rank"}
