"""Model layer: leak-free encoder stage, CV summary, grid search, artifacts,
label indexing, stream-static scoring."""

import tempfile

import pytest
from pyspark.sql import functions as F

from tabsieve.functions import scalar as S
from tabsieve.operators import encode
from tabsieve.operators import model as M
from tabsieve.plans import modelling as MM
from tabsieve.sources import readers
from tabsieve.streaming import scoring

from conftest import SF_SMALL


def test_label_index_alphabetical(spark):
    df = spark.createDataFrame([("True",), ("False",), ("True",), ("True",)], "label string")
    out = {r["label"]: r["label_idx"] for r in M.label_index(df, "label").collect()}
    assert out == {"False": 0.0, "True": 1.0}


def test_year_of(spark):
    df = spark.createDataFrame([("1999-05-01",), ("bad",), (None,)], "d string")
    assert [r[0] for r in df.select(S.year_of("d")).collect()] == [1999, None, None]


def test_select_features_order_and_prefixes():
    cols = ["genre_b", "x", "log_votes", "runtime", "mltag_a", "genre_a"]
    assert M.select_features(cols) == ["runtime", "log_votes", "genre_b", "genre_a", "mltag_a"]
    assert M.select_features(cols, selected=["mltag_a", "runtime", "nope"]) == ["mltag_a", "runtime"]


def test_encoder_stage_refits_per_fold(spark):
    data = MM._training_table(spark, SF_SMALL)
    enc = MM._encoder(spark, SF_SMALL)
    a = enc.fit(data.where(F.col("fold") != 0))
    b = enc.fit(data.where(F.col("fold") != 1))
    ea = {r["o_orderkey"]: r["director_prestige"] for r in a.transform(data).collect()}
    eb = {r["o_orderkey"]: r["director_prestige"] for r in b.transform(data).collect()}
    assert ea.keys() == eb.keys() and any(abs(ea[k] - eb[k]) > 1e-12 for k in ea)


def test_cv_summary_and_tuning(spark):
    data = MM._training_table(spark, SF_SMALL)
    pipe = M.forest_pipeline(MM._encoder(spark, SF_SMALL), MM.MODEL_FEATURES, "y",
                             num_trees=5, max_depth=3)
    acc, oof = M.cross_validate(pipe, data, "fold", "y", keys=["o_orderkey"])
    rows = acc.collect()
    assert len(rows) == 5 and all(0 <= r["accuracy"] <= 1 for r in rows)
    assert oof.count() == data.count()
    summ = M.cv_summary(acc).collect()[0]
    assert summ["n_folds"] == 5 and 0 <= summ["cv_std"] < 1
    rf = pipe.getStages()[-1]
    cvm = M.tune_forest(pipe, data, "fold", "y", grid={rf.maxDepth: [2, 3]}, parallelism=2)
    assert len(cvm.avgMetrics) == 2


def test_saved_model_predicts_the_same(spark):
    model = MM._fit_final(spark, SF_SMALL, num_trees=3, max_depth=3)
    out = tempfile.mkdtemp(prefix="tabsieve-model-")
    readers.save_model(model, out)
    again = readers.load_model(spark, out, [b[0] for b in MM._encoder(spark, SF_SMALL)._bridges])
    data = MM._training_table(spark, SF_SMALL)
    p, q = (sorted((r.o_orderkey, round(r.probability[1], 9)) for r in m.transform(data).select(
        "o_orderkey", "probability").collect()) for m in (model, again))
    assert p == q and len({x for _, x in p}) > 3


def test_default_stays_unless_beaten(spark):
    data = MM._training_table(spark, SF_SMALL)
    kw = dict(encoder=MM._encoder(spark, SF_SMALL), features=MM.MODEL_FEATURES, num_trees=4, max_depth=3)
    same = M.train(data, grid=[{"num_trees": 4, "max_depth": 3}], **kw)  # a tie
    assert same["settings"] == {"num_trees": 4, "max_depth": 3} and 0.3 <= same["threshold"] <= 0.7
    assert same["oof"].count() == data.count()
    hidden = spark.createDataFrame([(1, 10 ** 9), (0, 7)], "row_id long, o_orderkey long")
    feats = M.feature_matrix(MM.derived(spark, SF_SMALL), ["o_orderkey"], MM.BASE_FEATURES)
    got = M.predict_in_order(hidden, feats, "o_orderkey", same["model"], same["threshold"]).collect()
    assert [r.o_orderkey for r in got] == [7, 10 ** 9]  # the key without features is scored with zeros


def test_stream_static_scoring(spark):
    lab = spark.createDataFrame([("a", 1), ("b", 0), ("c", 1), ("d", 1)], "e string, y int")
    bridge = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", "q"), ("d", "p"),
                                    ("e", "p"), ("e", "q")], "e string, p string")
    scores, gm = scoring.fit_static(lab, bridge, "e", "p", "y")
    d = tempfile.mkdtemp(prefix="tabsieve-stream-")
    spark.createDataFrame([("e",), ("f",)], "e string").write.mode("overwrite").parquet(d + "/in")
    stream = spark.readStream.schema("e string").parquet(d + "/in")
    out = scoring.encode_stream(stream, bridge, scores, gm, "e", "p", "enc", "cnt")
    q = out.writeStream.format("memory").queryName("enc_out").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    got = {r["e"]: r["enc"] for r in spark.sql("SELECT * FROM enc_out").collect()}
    assert got["e"] == pytest.approx(0.750518, abs=1e-6) and got["f"] == pytest.approx(0.75)


def test_fold_iterations_equal_per_fold_refits(spark):
    data = MM._training_table(spark, SF_SMALL)
    lab = data.select("o_orderkey", "y", "fold")
    bs = MM.supplier_bridge(spark, SF_SMALL).withColumnRenamed("l_orderkey", "o_orderkey")
    it = {(r["fold_iter"], r["o_orderkey"]): (r["enc"], r["cnt"]) for r in
          encode.fold_iteration_encode(lab, bs, "o_orderkey", "l_suppkey", "y", "fold",
                                       "enc", "cnt").collect()}
    for f in range(5):
        ref = encode.target_encode(lab.where(F.col("fold") != f), lab, bs, "o_orderkey",
                                   "l_suppkey", "y", "enc", "cnt")
        for r in ref.collect():
            e, c = it[(f, r["o_orderkey"])]
            assert e == pytest.approx(r["enc"], abs=1e-12) and c == r["cnt"]


def test_predict_ordered_follows_file_order(spark):
    import pyarrow.parquet as pq
    keys = pq.read_table(f"{SF_SMALL}/orders.parquet", columns=["o_orderkey"]).column(0).to_pylist()
    want = [k for k in keys if k % 10 >= 8]
    got = [r["o_orderkey"] for r in MM.predict_ordered(spark, SF_SMALL).collect()]
    assert got == want
