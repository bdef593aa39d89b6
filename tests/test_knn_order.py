"""Shared order of kNN permutations, spread of repeated values, exact U."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsieve.functions import special
from tabsieve.operators import stats


def long_table(spark, n, share=0.4, seed=1, features=("a", "flag")):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rnd.random() < share)
        value = {"a": rnd.gauss(y, 1), "flag": float(rnd.random() < 0.3 + 0.3 * y), "const": 2.0,
                 "few": float(rnd.randrange(4)), "log": rnd.lognormvariate(0, 3)}
        rows += [(i, y, f, value[f]) for f in features]
    return spark.createDataFrame(rows, "id long, y int, feature string, x double").repartition(4)


def replicated(long, n_perms, k):
    labels = stats.permuted_labels(long.select("id", "y").distinct(), n_perms)
    return stats.mi_knn(long.drop("y").join(labels, "id"), k, keys=("perm", "feature"), scale_from=long)


def table(df):
    return {(r.perm, r.feature): r.mi for r in df.collect()}


@pytest.mark.parametrize("chunk", [stats.CHUNK_ROWS, 150])
def test_permutations_share_one_order(spark, chunk):
    long = long_table(spark, 700, features=("a", "flag", "few", "log"))
    got, want = table(stats.mi_knn_permuted(long, 6, 3, chunk_rows=chunk)), table(replicated(long, 6, 3))
    assert got.keys() == want.keys() and len(got) == 24
    assert all(got[k] == pytest.approx(want[k], abs=1e-11) for k in want)


def test_rare_class_takes_the_exact_way(spark):
    """Few rows of one class: chunks do not hold its neighbours, the result is the same."""
    long = long_table(spark, 900, share=0.02, seed=6, features=("a",))
    got, want = table(stats.mi_knn_permuted(long, 4, 3, chunk_rows=40)), table(replicated(long, 4, 3))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-11) for k in want)


def test_tiny_classes_and_missing_values(spark):
    long = long_table(spark, 30, share=0.1, seed=2, features=("a", "const"))
    got, want = table(stats.mi_knn_permuted(long, 3, 5)), table(replicated(long, 3, 5))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-11) for k in want)


def test_shuffled_rows_do_not_grow_with_permutations(spark, monkeypatch):
    long = long_table(spark, 400, features=("a",))
    keep, seen = stats.cut_lineage, {}

    def plan(n):
        made = []
        monkeypatch.setattr(stats, "cut_lineage", lambda df: made.append(df) or keep(df))
        stats.mi_knn_permuted(long, n, 3)
        return made[-1]._jdf.queryExecution().optimizedPlan().toString()

    for n in (2, 40):
        text = plan(n)
        seen[n] = text.count("Generate "), text.count("Join "), text.count("Window ")
        assert "explode(sequence" not in text
    assert seen[2] == seen[40] and seen[2][0] == 1  # the one explode deals rows to chunks


def test_neighbour_counts_against_all_pairs():
    rnd = np.random.default_rng(3)
    v, k = np.sort(rnd.random(90).round(2) + rnd.random(90) * 1e-9), 3
    labels = rnd.integers(0, 2, 90)
    m, unsure = stats.neighbour_counts(v, labels, slice(0, 90), k, True, True)
    assert unsure == 0
    for i in range(90):
        same = np.sort(np.abs(np.delete(v, i)[np.delete(labels, i) == labels[i]] - v[i]))
        r = same[k - 1] * (1 - 1e-12)
        assert m[i] == max(1, (np.abs(v - v[i]) < r).sum())
    part, unsure = stats.neighbour_counts(v[20:60], labels[20:60], slice(15, 25), k, False, False)
    assert unsure == 0 and (part == m[35:45]).all()
    _, unsure = stats.neighbour_counts(v[20:60], labels[20:60], slice(0, 40), k, False, False)
    assert unsure > 0


@pytest.mark.parametrize("feature", ["flag", "const", "few"])
def test_rows_of_one_value_spread(spark, feature):
    """No sub-bucket of the ordered prefix holds over 1 % of the rows."""
    n = 60_000
    x = {"flag": F.col("id") % 2, "const": F.lit(7), "few": F.col("id") % 4 * 1000 + 1}[feature]
    long = spark.range(n).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"), F.lit(feature).alias("feature"),
                                 x.cast("double").alias("x"))
    pts = stats.jittered(long, stats.value_scale(long, 1e-10), ["feature", "id", "y"])
    most = pts.groupBy("feature", stats.clump_bucket(F.col("v")).alias("b")).count().agg(F.max("count")).first()[0]
    assert most <= n // 100


def test_buckets_keep_the_order(spark):
    long = long_table(spark, 3000, features=("few", "flag", "a", "const"))
    pts = stats.jittered(long, stats.value_scale(long, 1e-10), ["feature", "id"])
    rows = pts.select("feature", "v", stats.clump_bucket(F.col("v")).alias("b")).collect()
    for f in ("few", "flag", "a", "const"):
        some = sorted((r.v, tuple(r.b)) for r in rows if r.feature == f)
        assert [b for _, b in some] == sorted(b for _, b in some)


# ------------------------------------------------------------------ exact U
def enumerated(u, n0, n1):
    stats_of = [sum(r) - n0 * (n0 + 1) // 2 for r in itertools.combinations(range(1, n0 + n1 + 1), n0)]
    far = max(u, n0 * n1 - u)
    return min(1.0, 2 * sum(s >= far for s in stats_of) / len(stats_of))


@pytest.mark.parametrize("n0, n1", [(1, 1), (1, 6), (3, 2), (4, 5), (6, 6), (8, 3)])
def test_exact_u_equals_enumeration(n0, n1):
    for u in range(n0 * n1 + 1):
        assert special.u_two_sided_p(u, n0, n1) == pytest.approx(enumerated(u, n0, n1), abs=1e-15)


def test_exact_u_of_the_largest_classes():
    counts = [special.u_tail_count(u, 8, 8) for u in range(65)]
    assert counts[-1] == 12870 and counts[31] + special.u_tail_count(32, 8, 8) == 12870
    assert special.u_two_sided_p(0, 1, 1000) == pytest.approx(2 / 1001)


def test_small_classes_are_exact_ties_are_not(spark):
    rows = [(i, i % 2, "plain", float(i * i)) for i in range(9)] + [(i, i % 2, "tied", float(i // 2)) for i in range(9)] \
        + [(i, 0, "one class", float(i)) for i in range(5)]
    long = spark.createDataFrame(rows, "id long, y int, feature string, x double")
    got = {r.feature: r for r in stats.mann_whitney(long).collect()}
    assert got["plain"].p_value == pytest.approx(enumerated(int(got["plain"].u), 5, 4))
    assert got["tied"].p_value != pytest.approx(enumerated(int(got["tied"].u), 5, 4), abs=1e-4)
    assert got["one class"].p_value == 1.0
