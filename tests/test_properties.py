"""Property tests (few examples each: every example runs Spark jobs)."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsieve.operators import encode, model, stats

SETTINGS = dict(max_examples=6, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(st.lists(st.floats(min_value=1e-6, max_value=1.0), min_size=1, max_size=25))
def test_bh_bounds_and_monotone(spark, ps):
    df = spark.createDataFrame([(f"f{i:03d}", p) for i, p in enumerate(ps)], "feature string, p_value double")
    out = sorted(((r["p_value"], r["p_adj"]) for r in stats.bh_adjust(df).collect()))
    for p, a in out:
        assert p - 1e-15 <= a <= 1.0
    adj = [a for _, a in out]
    assert all(x <= y + 1e-15 for x, y in zip(adj, adj[1:]))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 1), st.integers(0, 6)),
                min_size=2, max_size=60))
def test_smoothed_score_between_person_and_global_mean(spark, rows):
    lab = spark.createDataFrame([(e, y) for e, y, _ in rows], "e long, y int").dropDuplicates(["e"])
    bridge = spark.createDataFrame([(e, p) for e, _, p in rows], "e long, p long")
    scores, gm = encode.smoothed_scores(lab, bridge, "e", "p", "y", k=20)
    j = lab.join(bridge, "e")
    g = j.agg(F.avg("y")).first()[0]
    pm = {r["p"]: r["m"] for r in j.groupBy("p").agg(F.avg("y").alias("m")).collect()}
    for r in scores.collect():
        lo, hi = sorted((pm[r["p"]], g))
        assert lo - 1e-12 <= r["__score"] <= hi + 1e-12


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.floats(0, 1), st.integers(0, 1)), min_size=1, max_size=80))
def test_threshold_sweep_is_lowest_argmax(spark, rows):
    df = spark.createDataFrame(rows, "p double, y int")
    out = {r["t_pct"]: (r["accuracy"], r["is_best"]) for r in model.threshold_sweep(df).collect()}
    p = np.array([r[0] for r in rows])
    y = np.array([r[1] for r in rows])
    acc = {t: float(np.mean((p >= t / 100.0).astype(int) == y)) for t in range(30, 71)}
    for t, (a, _) in out.items():
        assert a == pytest.approx(acc[t], abs=1e-12)
    best = max(acc.values())
    assert [t for t, (_, b) in out.items() if b] == [min(t for t in acc if acc[t] == best)]


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 9), st.integers(0, 9)),
                min_size=6, max_size=60).filter(lambda r: len({y for y, _, _ in r}) == 2))
def test_mann_whitney_mi_spearman_properties(spark, rows):
    df = spark.createDataFrame([(i, y, float(a), float(b)) for i, (y, a, b) in enumerate(rows)],
                               "id long, y int, a double, b double")
    long = stats.to_long(df, "id", "y", ["a", "b"])
    for r in stats.mann_whitney(long).collect():
        u1 = r["n0"] * r["n1"] - r["u"]
        assert r["u"] + u1 == pytest.approx(r["n0"] * r["n1"])
        assert 0 <= r["p_value"] <= 1
    assert all(r["mi"] >= 0 for r in stats.mi_binned(long, 4).collect())
    rw = stats.rank_wide(long, ["a", "b"], materialize=False)
    ab = stats.spearman_pairs(rw, ["a", "b"]).collect()[0]["rho"]
    ba = stats.spearman_pairs(rw, ["b", "a"]).collect()[0]["rho"]
    assert (ab is None and ba is None) or ab == pytest.approx(ba)


def test_screen_and_screen_in_folds(spark):
    import random
    rnd = random.Random(2)
    rows = []
    for i in range(160):
        y = rnd.randint(0, 1)
        a = y * 3 + rnd.random()          # informative
        rows.append((i, y, a, a * 2.0 + 0.001 * rnd.random(), rnd.random()))  # b ~ a, c noise
    df = spark.createDataFrame(rows, "id long, y int, a double, b double, c double")
    long = stats.to_long(df, "id", "y", ["a", "b", "c"])
    rep = {r["feature"]: r for r in stats.screen(long, ["a", "b", "c"], n_perms=19,
                                                 estimator="binned", bins=4).collect()}
    assert rep["a"]["passed_tests"] == 1 and rep["b"]["passed_tests"] == 1
    assert rep["c"]["selected"] == 0
    assert rep["a"]["selected"] + rep["b"]["selected"] == 1  # redundant pair, one kept
    folds = df.select("id", (F.col("id") % 3).alias("fold"))
    per = stats.screen_in_folds(long, folds, features=["a", "b", "c"], n_perms=9,
                                estimator="binned", bins=4).collect()
    assert sorted({r["fold"] for r in per}) == [0, 1, 2] and len(per) == 9
