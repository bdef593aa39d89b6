"""What screening plans, counts and ranks as its input grows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from tabsieve.operators import stats


def long_table(spark, n):
    rnd = random.Random(4)
    return spark.createDataFrame([(i, i % 3 // 2, f, rnd.gauss(i % 3 // 2, 1)) for i in range(n) for f in "ab"],
                                 "id long, y int, feature string, x double")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_plan_repeats_the_steps_before_it(spark, monkeypatch):
    """Radii, bounds and counts read written tables: repeated at every use, the order of
    the points made plans of hundreds of stages, more than a driver holds at size."""
    plans, keep = [], stats.cut_lineage
    monkeypatch.setattr(stats, "cut_lineage", lambda df: plans.append(plan_of(df)) or keep(df))
    plans.append(plan_of(stats.mi_knn(long_table(spark, 60))))
    assert max(p.count("Window ") for p in plans) <= 3
    assert max(p.count("Join ") for p in plans) <= 10


def brute_cuts(rows, n_perms):
    n1 = sum(y for _, y in rows)
    keys = [sorted((hashlib.md5(f"{p}:{i}".encode()).hexdigest() + str(i) if i is not None else "") for i, _ in rows)
            for p in range(n_perms)]
    return [k[n1 - 1] if 0 < n1 <= len(k) else "" for k in keys]


@pytest.mark.parametrize("reach", [12.0, 0.05])
@pytest.mark.parametrize("rows", [
    [(i, int(i % 5 == 0)) for i in range(3000)], [(None, 1), *((i, i % 2) for i in range(40))], [(None, 1), (None, 0), (7, 0)],
    [(i, 0) for i in range(9)], [(i, 1) for i in range(9)], [(i // 2, i % 2) for i in range(200)]],
    ids=["many", "one without id", "labels without id", "no label 1", "all labels 1", "ids twice"])
def test_cuts_equal_a_sort_of_all_keys(spark, rows, reach):
    """Also where the window misses the cut and is widened."""
    df = spark.createDataFrame(rows, "id long, y int").repartition(3)
    assert stats.permutation_cuts(df, 7, reach) == brute_cuts(rows, 7)


def test_only_keys_near_the_cut_are_ranked():
    ids, perms = [str(i).encode() for i in range(8000)], list(range(5))
    low, high = int(0.29 * 2**64), int(0.31 * 2**64)
    out = pa.Table.from_batches(stats._near(perms, low, high)(iter([pa.RecordBatch.from_arrays([pa.array(ids)], ["id"])])))
    under, inside = out.filter(pc.is_null(out["key"])), out.filter(pc.is_valid(out["key"]))
    assert len(under) == len(perms) and 0.015 * 40000 < len(inside) < 0.025 * 40000
    for p in perms:
        heads = [int(hashlib.md5(b"%d:%s" % (p, i)).hexdigest()[:16], 16) for i in ids]
        assert under["c"][under["perm"].to_pylist().index(p)].as_py() == sum(h < low for h in heads)
        assert inside["perm"].to_pylist().count(p) == sum(low <= h <= high for h in heads)


def test_bits_equal_the_labels(spark):
    rows = spark.createDataFrame([(f"k{i}", i % 4 // 3) for i in range(700)] + [(None, 1)], "id string, y int").repartition(3)
    cuts = [*stats.permutation_cuts(rows, 11), ""]
    want = {r.id: r.labels for r in rows.select("id", stats.label_vector(cuts, "id").alias("labels")).collect()}
    got = {r.id: np.unpackbits(np.frombuffer(r.bits, np.uint8), count=12).tolist() for r in stats.permuted_bits(rows, cuts).collect()}
    assert got == want and sum(map(sum, want.values())) == 11 * (175 + 1 - 1)
