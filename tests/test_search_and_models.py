"""Sampled search with halving, saved pipelines of any stages, keep-first with ties."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from tabsieve.operators import clean, model as M
from tabsieve.sources import readers


def test_drawn_settings_repeat_and_stay_in_range():
    ranges = {"num_trees": (2, 5), "rate": (0.1, 0.2)}
    a = M.drawn_settings(ranges, 60, seed=3)
    assert a == M.drawn_settings(dict(reversed(ranges.items())), 60, seed=3) != M.drawn_settings(ranges, 60, seed=4)
    assert {s["num_trees"] for s in a} == {2, 3, 4, 5} and all(0.1 <= s["rate"] <= 0.2 for s in a)
    assert a[:10] == M.drawn_settings(ranges, 10, seed=3)


def rows(spark, n=300):
    return spark.range(n).select("id", (F.col("id") % 3).alias("fold"), ((F.col("id") * 37) % 100).cast("double").alias("a"),
                                 ((F.col("id") * 37) % 100 > 50).cast("int").alias("y"))


class Fixed:
    """A learner whose accuracy its setting names: predicts y correctly for a share of the ids."""

    def __init__(self, share):
        self.share = share

    def fit(self, train):
        return self

    def transform(self, df):
        right = F.pmod(F.xxhash64("id"), F.lit(100)) < self.share
        return df.withColumn("prediction", F.when(right, F.col("y")).otherwise(1 - F.col("y")).cast("double"))


def test_halving_ranks_settings_and_counts_fits(spark):
    made = []

    def fit(encoder, features, label, share):
        made.append(share)
        return Fixed(share)

    got = M.search_forest(rows(spark), None, ["a"], {"share": (5, 95)}, n=8, fold_col="fold", default={"share": 50}, fit=fit)
    drawn = [s["share"] for s in M.drawn_settings({"share": (5, 95)}, 8)]
    assert got["settings"]["share"] == max(drawn) and got["accuracy"] > 0.5
    assert got["fits"] == len(made) == (8 + 1) + (4 + 1) + (2 + 1)  # drawn ones halve, the default stays
    by = {i: [f for j, f, _ in got["scores"] if j == i] for i in range(-1, 8)}
    assert by[-1] == [0, 1, 2] and sum(len(v) == 3 for v in by.values()) == 3


def test_default_stays_unless_beaten(spark):
    fit = lambda encoder, features, label, share: Fixed(share)
    got = M.search_forest(rows(spark, 90), None, ["a"], {"share": (5, 60)}, n=3, default={"share": 100}, fit=fit)
    assert got["settings"] == {"share": 100} and got["accuracy"] == 1.0
    same = M.search_forest(rows(spark, 90), None, ["a"], {"share": (100, 100)}, n=2, default={"share": 200}, fit=fit)
    assert same["settings"] == {"share": 200}


def test_search_fits_forests(spark):
    got = M.search_forest(rows(spark, 120), None, ["a"], {"num_trees": (1, 2), "max_depth": (1, 3)}, n=2,
                          default={"num_trees": 1, "max_depth": 1})
    assert got["accuracy"] > 0.8 and got["fits"] == 3 + 2 + 2


def test_any_pipeline_round_trips(spark, tmp_path):
    """More than ten stages and another learner than the forest."""
    data = rows(spark)
    stages, last = [VectorAssembler(inputCols=["a"], outputCol="v0")], "v0"
    for i in range(1, 11):
        kind = MinMaxScaler if i % 2 else StandardScaler
        stages.append(kind(inputCol=last, outputCol=f"v{i}"))
        last = f"v{i}"
    stages.append(LogisticRegression(featuresCol=last, labelCol="y", maxIter=5))
    fitted = Pipeline(stages=stages).fit(data)
    readers.save_model(fitted, str(tmp_path / "m"))
    again = readers.load_model(spark, str(tmp_path / "m"))
    assert [type(s) for s in again.stages] == [type(s) for s in fitted.stages] and len(again.stages) == 12
    want = [r.probability for r in fitted.transform(data).orderBy("id").collect()]
    assert [r.probability for r in again.transform(data).orderBy("id").collect()] == want


def test_keep_first_is_the_same_for_any_partitioning(spark):
    df = spark.createDataFrame([(k, 1, f"t{i % 7}", None if i % 5 else i, {"m": i % 2}) for k in range(5) for i in range(60)],
                               "k int, o int, t string, n int, m map<string,int>")
    got = []
    for parts in (1, 3, 17):
        some = clean.dedup_first(df.drop("m").repartition(parts, F.rand(parts)), ["k"], [("o", "desc")])
        got.append(sorted(tuple(r) for r in some.collect()))
    assert got[0] == got[1] == got[2] and got[0][0] == (0, 1, "t0", None)
    assert clean.dedup_first(df, ["k"], [("o", "asc"), ("t", "asc")]).count() == 5  # maps do not sort


@pytest.mark.parametrize("value", [None, 3])
def test_keep_first_single_rows(spark, value):
    df = spark.createDataFrame([(1, value, "x")], "k int, o int, t string")
    assert [tuple(r) for r in clean.dedup_first(df, ["k"], [("o", "desc")]).collect()] == [(1, value, "x")]
