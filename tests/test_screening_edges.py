"""Screening on the features that real tables hold: constants, flags, missing
and infinite values, collinear controls, string keys, heavy ties."""

import random

import pytest
from pyspark.sql import functions as F
from scipy_free import two_sided_t

from tabsieve.functions import special
from tabsieve.operators import stats


@pytest.fixture(scope="module")
def wide(spark):
    rnd, rows = random.Random(1), []
    for i in range(300):
        y = i % 3 == 0
        rows.append((f"tt{i:07d}", int(y), 0.0, float(rnd.random() < (0.8 if y else 0.3)), rnd.gauss(float(y), 1),
                     float("nan") if i % 50 == 0 else float("inf") if i % 50 == 1 else rnd.random()))
    return spark.createDataFrame(rows, "key string, y int, zero double, flag double, x double, odd double")


FEATURES = ["zero", "flag", "x", "odd"]


def test_constant_feature_does_not_stop_the_screening(wide):
    long = stats.to_long(wide, "key", "y", ["zero", "flag", "x"])
    mw = {r.feature: r for r in stats.mann_whitney(long).collect()}
    assert mw["zero"].z is None and mw["zero"].p_value == 1.0 and mw["x"].p_value < 1e-6
    assert [r.feature for r in stats.point_biserial_top(long, 5).collect()] == ["flag", "x"] or \
        [r.feature for r in stats.point_biserial_top(long, 5).collect()] == ["x", "flag"]
    ranks = stats.rank_wide(long, ["zero", "flag", "x"])
    rho = {(r.feature_a, r.feature_b): r.rho for r in stats.spearman_pairs(ranks, ["zero", "flag", "x"]).collect()}
    assert rho["zero", "flag"] is None and rho["flag", "x"] is not None
    report = {r.feature: r for r in stats.screen(long, ["zero", "flag", "x"], [("x", ["flag"])], n_perms=20,
                                                 estimator="binned").collect()}
    assert not report["zero"].selected and report["x"].selected


def test_collinear_and_constant_controls(wide):
    df = wide.withColumn("twice", F.col("x") * 2)
    ranks = stats.rank_wide(stats.to_long(df, "key", "y", ["x", "twice", "zero", "flag"]), ["x", "twice", "zero", "flag"])
    got = {r.feature: r for r in stats.partial_spearman(
        ranks, [("x", ["twice", "zero"]), ("flag", ["zero"])]).collect()}
    assert got["x"].rho is None and got["x"].p_value == 1.0  # nothing left of x
    assert got["flag"].p_value < 1e-6
    perfect = stats.partial_spearman(ranks.withColumn("copy", F.col("__label")), [("copy", ["zero"])]).first()
    assert perfect.rho == pytest.approx(1) and perfect.p_value == 0.0


def test_permutations_of_string_keys(wide):
    rows = wide.select(F.col("key").alias("id"), "y")
    got = stats.permuted_labels(rows, 7).collect()
    assert len(got) == 2100
    for p in range(7):
        assert sum(r.y for r in got if r.perm == p) == 100
    assert len({tuple(sorted(r.id for r in got if r.perm == p and r.y)) for p in range(7)}) == 7
    mi = stats.mi_permutation(stats.to_long(wide, "key", "y", ["flag", "x"]), 30, 10).collect()
    assert all(r.p_value < 0.1 for r in mi)
    none = stats.permuted_labels(rows.withColumn("y", F.lit(0)), 3)
    assert none.agg(F.sum("y")).first()[0] == 0


def test_missing_and_infinite_values(wide):
    long = stats.to_long(wide, "key", "y", ["odd"])
    assert long.filter("x IS NULL").count() == 6 and long.filter(F.isnan("x")).count() == 0
    ranks = stats.row_ranks(long.filter("x IS NOT NULL"))
    assert ranks.agg(F.max("rank")).first()[0] == pytest.approx((289 + 294) / 2)


def test_ties_beyond_the_jitter(spark):
    rnd = random.Random(2)
    rows = [(i, int(rnd.random() < 0.5), "f", float(rnd.random() < 0.5)) for i in range(3000)]
    long = spark.createDataFrame(rows, "id long, y int, feature string, x double")
    assert stats.mi_knn(long).first().mi < 0.02
    # so small a jitter leaves many rows exactly equal: the flag must not look informative
    assert stats.mi_knn(long, jitter=1e-14).first().mi < 0.2


@pytest.mark.parametrize("t,df", [(0.0, 5), (0.5, 1), (1.0, 1), (2.0, 3), (2.5, 30), (-3.1, 12), (8.0, 100), (5.0, 100000),
                                  (30.0, 2), (12.7, 1)])
def test_t_tail(t, df):
    assert special.t_two_sided_p(t, df) == pytest.approx(two_sided_t(t, df), rel=1e-6, abs=1e-14)
