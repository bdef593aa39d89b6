"""One pass for all folds' encodings: equal to refitting the encoder, and no fit a fold."""

from pyspark.sql import functions as F

from tabsieve.operators import encode
from tabsieve.operators import model as M


def _rows(spark):
    lab = [(i, i % 2 if i % 7 else 1, i % 3, float(i % 5)) for i in range(60)] + [(7, 1, 1, 2.0), (None, 0, 2, 1.0)]
    crew = [(i, None if i % 11 == 0 else (i * j) % 9) for i in range(70) for j in range(1, 4) if i % 13]
    return (spark.createDataFrame(lab, "id long, y int, fold int, a double"),
            spark.createDataFrame(crew, "id long, who long"))


def test_fold_encodings_equal_refits(spark):
    lab, crew = _rows(spark)
    enc = M.SmoothedEncoder(bridges=[(crew, "who", "d", "n")], entityCol="id", labelCol="y", k=3.0)
    wide = enc.fold_encoded(lab, "fold", [0, 1, 2])
    for i in range(3):
        fitted = enc.fit(lab.where(F.col("fold") != i)).transform(lab)
        want = fitted.select("id", "y", "fold", "a", F.round("d", 9).alias("d"), "n").collect()
        got = M.fold_view(wide, ["d"], i).select("id", "y", "fold", "a", F.round("d", 9).alias("d"), "n").collect()
        assert sorted(map(str, got)) == sorted(map(str, want))


def test_training_fits_the_encoder_once(spark, monkeypatch):
    lab, crew = _rows(spark)
    calls, real = [], encode.smoothed_scores
    monkeypatch.setattr(encode, "smoothed_scores", lambda *a, **k: calls.append(1) or real(*a, **k))
    enc = M.SmoothedEncoder(bridges=[(crew, "who", "d", "n")], entityCol="id", labelCol="y", k=3.0)
    out = M.train(lab, enc, ["a", "d", "n"], keys=["id"], num_trees=2, max_depth=2)
    assert len(calls) == 1  # the final fit; one a fold before
    assert out["oof"].count() == 62


def test_encodings_are_made_once_for_all_transforms(spark, monkeypatch):
    lab, crew = _rows(spark)
    enc = M.SmoothedEncoder(bridges=[(crew, "who", "d", "n")], entityCol="id", labelCol="y", k=3.0)
    fitted, calls, real = enc.fit(lab), [], M.cut_lineage
    monkeypatch.setattr(M, "cut_lineage", lambda df: calls.append(1) or real(df))
    one, two = fitted.transform(lab), fitted.transform(lab.where("fold = 0"))
    assert len(calls) == 1 and one.count() == 62
    assert sorted(map(str, one.where("fold = 0").collect())) == sorted(map(str, two.collect()))


def test_wide_iterations_equal_the_long_ones(spark):
    lab, crew = _rows(spark)
    args = (lab.where("id is not null and id <> 7"), crew, "id", "who", "y", "fold", "d", "n")
    long = {(r["fold_iter"], r["id"]): (round(r["d"], 9), r["n"]) for r in encode.fold_iteration_encode(*args).collect()}
    wide = encode.fold_iteration_encode(*args, wide=True).collect()
    assert {(i, r["id"]): (round(r[f"d__{i}"], 9), r["n"]) for r in wide for i in range(3)} == long
