"""Graph ranking, factorisation and stacking against plain numpy versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsieve.operators import factor, graph, stack


# ------------------------------------------------------------------ ranking
def brute_ranks(edges, nodes, rounds, damping=0.85):
    names = sorted({x for e in edges for x in e[:2]} | set(nodes))
    at = {x: i for i, x in enumerate(names)}
    w = np.zeros((len(names), len(names)))
    for a, b, x in edges:
        w[at[a], at[b]] += x
    out, n = w.sum(1), len(names)
    step = np.where(out[:, None] > 0, w / np.where(out > 0, out, 1)[:, None], 1 / n)
    r = np.full(n, 1 / n)
    for _ in range(rounds):
        r = (1 - damping) / n + damping * step.T @ r
    return dict(zip(names, r))


def edge_table(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string, weight double").repartition(3)


@pytest.mark.parametrize("split", [graph.SPLIT, 4])
def test_ranks_equal_dense_walk(spark, split):
    rnd = random.Random(5)
    edges = [(f"n{int(rnd.expovariate(0.2))}", f"n{rnd.randrange(40)}", rnd.choice([1.0, 1.0, 2.5])) for _ in range(300)]
    edges += [("hub", f"n{i}", 1.0) for i in range(40)] + [(f"n{i}", "sink", 1.0) for i in range(9)]
    nodes = ["alone", "n3"]
    got = graph.pagerank(edge_table(spark, edges), spark.createDataFrame([(x,) for x in nodes], "node string"),
                         rounds=12, tol=0.0, split=split).collect()
    want = brute_ranks(edges, nodes, 12)
    assert {r.node: pytest.approx(r["rank"], abs=1e-12) for r in got} == want
    assert sum(r["rank"] for r in got) == pytest.approx(1) and {r.rounds for r in got} == {12}


def test_ranks_settle_early_and_ignore_no_edges(spark):
    edges = [("a", "b", 1.0), ("b", "a", 1.0), (None, "a", 1.0), ("a", None, 1.0), ("c", "a", 0.0), ("a", "b", -1.0)]
    got = {r.node: r for r in graph.pagerank(edge_table(spark, edges), tol=1e-9).collect()}
    assert {k: r["rank"] for k, r in got.items()} == {"a": 0.5, "b": 0.5} and got["a"].rounds == 1
    assert graph.pagerank(edge_table(spark, edges).limit(0)).count() == 0
    lone = graph.pagerank(edge_table(spark, []), spark.createDataFrame([("x",), (None,)], "node string"))
    assert [(r.node, r["rank"]) for r in lone.collect()] == [("x", 1.0)]


def test_credit_ranks_by_side(spark):
    bridge = spark.createDataFrame([(1, 7), (1, 7), (1, 8), (2, 8), (3, None)], "t long, p long")
    got = {(r.side, r.key): r["rank"] for r in graph.credit_ranks(
        bridge, "t", "p", spark.createDataFrame([(1,), (9,)], "t long"), rounds=10, tol=0.0).collect()}
    edges = [(a, b, 1.0) for e, p in [(1, 7), (1, 7), (1, 8), (2, 8)] for a, b in ((f"e{e}", f"p{p}"), (f"p{p}", f"e{e}"))]
    want = brute_ranks(edges, ["e9"], 10)
    assert {("entity" if k[0] == "e" else "person", k[1:]): pytest.approx(v, abs=1e-12) for k, v in want.items()} == got


def test_edges_are_joined_in_place(spark, monkeypatch):
    """A round shuffles ranks and sums, not the edges: their side of the join has no exchange."""
    plans = []
    keep = graph.cut_lineage
    monkeypatch.setattr(graph, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        graph.pagerank(edge_table(spark, [(f"a{i % 50}", f"a{i % 7}", 1.0) for i in range(400)]), rounds=1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    walk = [p for p in plans if "Bucketed: true" in p]
    assert walk
    scan = next(i for i, line in enumerate(walk[0].splitlines()) if "Bucketed: true" in line)
    lines = walk[0].splitlines()
    above = [line for line in lines[:scan + 1]]
    join = max(i for i, line in enumerate(above) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in lines[join + 1:scan])


# ------------------------------------------------------------ factorisation
def rows_of(v, spark):
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "id long, v array<double>").repartition(4)


def test_factors_equal_plain_updates(spark):
    rnd = np.random.default_rng(2)
    v = rnd.random((60, 3)) @ rnd.random((3, 9))
    w, h = np.ones((60, 3)), factor.first_components(3, 9)
    want = []
    for _ in range(15):
        w = w * (v @ h.T) / (w @ (h @ h.T) + factor.TINY)
        h = h * (w.T @ v) / (w.T @ w @ h + factor.TINY)
        want.append(((v - w @ h) ** 2).sum())
    got_w, got_h, losses = factor.nmf(rows_of(v, spark), "id", "v", 3, 15)
    assert np.allclose(got_h, h) and np.allclose(losses, want)
    assert np.allclose(np.array([r.w for r in got_w.orderBy("id").collect()]), w)
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:])) and losses[-1] < 0.7 * losses[0]
    assert (got_h >= 0).all()


def test_factor_edges(spark):
    df = spark.createDataFrame([(1, [1.0, None, -3.0]), (1, [2.0]), (None, None), (2, []), (3, [float("nan"), 4.0, 1.0])],
                               "id long, v array<double>")
    w, h, losses = factor.nmf(df, "id", "v", 2, 6)
    rows = w.collect()
    assert len(rows) == 5 and h.shape == (2, 3) and np.isfinite(h).all()
    assert all(max(r.w) < 1e-6 for r in rows if r.id in (None, 2))
    assert all(b <= a + 1e-9 for a, b in zip(losses, losses[1:]))
    none, h, losses = factor.nmf(df.limit(0), "id", "v", 2, 3)
    assert none.count() == 0 and h.shape == (2, 0) and losses == []


# ----------------------------------------------------------------- stacking
def scores_of(spark, n=900, seed=3):
    rnd = np.random.default_rng(seed)
    x = rnd.random((n, 2))
    y = (rnd.random(n) < 1 / (1 + np.exp(-(4 * x[:, 0] + x[:, 1] - 2.5)))).astype(int)
    return x, y, spark.createDataFrame([(i, i % 3, int(y[i]), float(x[i, 0]), float(x[i, 1])) for i in range(n)],
                                       "id long, fold int, y int, a double, `b.c` double").repartition(4)


def plain_logistic(x, y, rounds):
    x, b = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-x @ b))
        b = b + np.linalg.solve((x.T * (p * (1 - p))) @ x + stack.RIDGE * np.eye(len(b)), x.T @ (y - p) - stack.RIDGE * b)
    return b


def test_stack_equals_plain_newton(spark):
    x, y, df = scores_of(spark)
    beta = stack.fit_stack(df, ["a", "b.c"])
    fold = np.arange(len(y)) % 3
    assert np.allclose(beta[None], plain_logistic(x, y, 12), atol=1e-8)
    for f in range(3):
        assert np.allclose(beta[f], plain_logistic(x[fold != f], y[fold != f], 12), atol=1e-8)
    out = stack.stacked(df, ["a", "b.c"], beta).orderBy("id").collect()
    want = [1 / (1 + np.exp(-(beta[i % 3] @ [1, *x[i]]))) for i in range(len(y))]
    assert np.allclose([r.p for r in out], want)


def test_held_out_labels_do_not_matter(spark):
    _, _, df = scores_of(spark)
    flipped = df.withColumn("y", F.when(F.col("fold") == 1, 1 - F.col("y")).otherwise(F.col("y")))
    a, b = stack.fit_stack(df, ["a", "b.c"]), stack.fit_stack(flipped, ["a", "b.c"])
    assert np.allclose(a[1], b[1], atol=1e-12) and not np.allclose(a[0], b[0], atol=1e-3)


def test_stack_edges(spark):
    _, _, df = scores_of(spark, 60)
    dirty = df.unionByName(df.limit(5).withColumn("a", F.lit(None).cast("double"))).unionByName(
        df.limit(5).withColumn("y", F.lit(None).cast("int")))
    assert np.allclose(stack.fit_stack(dirty, ["a", "b.c"])[None], stack.fit_stack(df, ["a", "b.c"])[None], atol=1e-9)
    assert not stack.fit_stack(df.limit(0), ["a"])[None].any()
    twins = df.withColumn("b.c", F.col("a"))  # collinear: the ridge splits the weight
    even = stack.fit_stack(twins, ["a", "b.c"])[None]
    assert even[1] == pytest.approx(even[2], rel=1e-6)
    sure = stack.fit_stack(df.withColumn("y", F.lit(1)), ["a"], rounds=30)[None]
    assert np.isfinite(sure).all()
