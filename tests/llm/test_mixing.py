import duckdb
import pytest
from pyspark.sql import functions as F

from tabsieve.llm import mixing

from corpus_fixtures import make_docs  # noqa: F401


def twin(pdf):
    con = duckdb.connect()
    con.register("documents", pdf)
    return sorted(con.execute(mixing.SQL).fetchall())


def fill(sizes, ratio=1.5, cap=2.0):
    """Targets by repeated resharing of the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, left = {}, sum(sizes.values()) * ratio
    while True:
        rest = [s for s in names if s not in full]
        share = {s: left * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = [s for s in rest if share[s] > cap * sizes[s]]
        if not over:
            return full | share
        for s in over:
            full[s] = cap * sizes[s]
            left -= full[s]


@pytest.fixture
def rows():
    out = []
    for i in range(400):
        source = [None, "b", "a", "é", "z", "big"][i % 6 if i < 150 else 5]
        out.append((i, " ".join(["w"] * (i * 37 % 97)) if i % 29 else None, source))
    return out


def test_equals_sql_and_filling(make_docs, rows):
    docs = make_docs(rows).withColumn("mix", F.lit(1)).withColumn("size", F.lit(2))
    got = sorted(tuple(r) for r in mixing.report(docs).collect())
    assert got == twin(make_docs(rows).toPandas())
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = fill(sizes)
    by_id = {r[0]: r[2] for r in rows}
    for s in sizes:
        mine = [r for r in got if by_id[r[0]] == s]
        assert mine[0][3] == pytest.approx(want[s]) and mine[0][2] == sizes[s]
        assert abs(sum(r[4] for r in mine) - want[s]) <= 97 / 2
    assert all(r[4] in (0, r[1], 2 * r[1]) for r in got)


def test_copies_take_effect(make_docs, rows):
    docs = make_docs(rows)
    taken = {r.doc_id: r.taken for r in mixing.report(docs).collect()}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    n = {r.doc_id: r.n for r in mixed.groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    size = {i: len((t or "").split()) for i, t, _ in rows}
    assert all(taken[i] == n.get(i, 0) * size[i] for i in taken)


def test_repeats_ties_empty_and_wordless(make_docs):
    assert mixing.report(make_docs([])).count() == 0
    blank = make_docs([(1, None, "a"), (2, "", None), (None, " \n", "a")])
    assert {r.taken for r in mixing.report(blank).collect()} == {0}
    rows = [(7, "a b c", "s")] * 5 + [(None, "x y", "s")] * 3 + [(7, "other text here now", "s")]
    once = sorted(map(str, mixing.report(make_docs(rows)).collect()))
    assert len(once) == 9 and once == sorted(map(str, mixing.report(make_docs(rows[::-1])).collect()))


def test_unequal_probabilities(make_docs):
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(3000)]
    docs = make_docs(rows)
    tilt = F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)
    out = mixing.apply(docs, mixing.plan(docs, tilt=tilt), tilt=tilt)
    mean = {r.odd: r.m for r in out.filter("source = 'c'").groupBy((F.col("doc_id") % 2).alias("odd"))
            .agg(F.avg("mix.copies").alias("m")).collect()}
    assert mean[0] > 1.5 * mean[1]  # tilted documents are taken more often
