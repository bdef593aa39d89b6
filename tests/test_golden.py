"""Golden micro-fixtures with hand-computed outputs (FIXTURES.md section C)."""

import math

import pytest
from pyspark.sql import functions as F

from tabsieve.functions import scalar as S
from tabsieve.functions.ranking import average_rank
from tabsieve.functions.textfold import fold_text
from tabsieve.operators import clean, encode, enrich, joins, model, stats


def test_c1_smoothing(spark):
    lab = spark.createDataFrame([("a", 1), ("b", 0), ("c", 1), ("d", 1)], "e string, y int")
    bridge = spark.createDataFrame([("a", "p"), ("b", "p"), ("c", "q"), ("d", "p"),
                                    ("e", "p"), ("e", "q")], "e string, p string")
    scores, gm = encode.smoothed_scores(lab, bridge, "e", "p", "y", k=20)
    got = {r["p"]: r["__score"] for r in scores.collect()}
    assert got["p"] == pytest.approx(17 / 23, abs=1e-9)
    assert got["q"] == pytest.approx(16 / 21, abs=1e-9)
    target = spark.createDataFrame([("e",), ("f",)], "e string")
    out = {r["e"]: r for r in encode.apply_scores(target, bridge, scores, gm, "e", "p",
                                                  "enc", "cnt").collect()}
    assert out["e"]["enc"] == pytest.approx(0.750518, abs=1e-6)
    assert out["f"]["enc"] == pytest.approx(0.75)
    assert out["f"]["cnt"] == 1 and out["e"]["cnt"] == 2


def test_c2_benjamini_hochberg(spark):
    p = [0.01, 0.04, 0.03, 0.005, 0.04]
    df = spark.createDataFrame([(f"f{i}", v) for i, v in enumerate(p)], "feature string, p_value double")
    out = {r["feature"]: r for r in stats.bh_adjust(df, alpha=0.04).collect()}
    assert [round(out[f"f{i}"]["p_adj"], 6) for i in range(5)] == [0.025, 0.04, 0.04, 0.025, 0.04]
    assert [out[f"f{i}"]["reject"] for i in range(5)] == [True, False, False, True, False]


def test_c3_clamp_and_null(spark):
    df = spark.createDataFrame([("\\N",), ("5000",), ("0",), ("abc",), ("12.7",)], "s string")
    r = df.select(S.parse_int("s").alias("v")).select(
        S.winsorize("v", 1, 210, "keep").alias("keep"),
        S.winsorize("v", 1, 210, "floor").alias("coded")).collect()
    assert [x["keep"] for x in r] == [None, 210, 1, None, 13]
    assert [x["coded"] for x in r] == [1, 210, 1, 1, 13]
    y = spark.createDataFrame([(None,), (2000,)], "y int")
    ages = y.select(S.age_from_year("y", 2026).alias("a"),
                    S.age_from_year("y", 2026, compat=True).alias("c")).collect()
    assert ages[0]["a"] is None and ages[0]["c"] == 1 and ages[1]["a"] == 26
    # votes NULL in an all-NULL bucket: intended NULL, coded = cap
    v = spark.createDataFrame([(1990, None), (1990, None), (2000, 5.0)], "year int, votes double")
    keep = clean.impute_bucket_median(v, "year", {"votes": {"cap": 400000.0, "null_policy": "keep"}})
    coded = clean.impute_bucket_median(v, "year", {"votes": {"cap": 400000.0, "null_policy": "floor"}})
    assert sorted([r["votes"] for r in keep.collect()], key=lambda x: (x is None, x)) == [5.0, None, None]
    assert sorted(r["votes"] for r in coded.collect()) == [5.0, 400000.0, 400000.0]


def test_c4_bucket_and_half_even(spark):
    df = spark.createDataFrame([(1999, 94.5), (1999, 95.5)], "y int, m double")
    r = df.select(S.time_bucket("y", 10).alias("b"), S.time_bucket("y", 10, compat=True).alias("c"),
                  S.round_half_even_int("m").alias("r")).collect()
    assert r[0]["b"] == 1990 and r[0]["c"] == pytest.approx(1999)
    assert [x["r"] for x in r] == [94, 96]


def test_c5_ids(spark):
    df = spark.createDataFrame([("1234",), ("12345678",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(S.canonical_id("s")).collect()] == \
        ["tt0001234", "tt12345678", None, None]


def test_c6_average_rank_and_spearman(spark):
    vc = spark.createDataFrame([("f", 10.0, 1), ("f", 20.0, 2), ("f", 30.0, 1)],
                               "feature string, x double, n long")
    r = {row["x"]: row["rank"] for row in average_rank(vc, "feature", "x", "n").collect()}
    assert r == {10.0: 1.0, 20.0: 2.5, 30.0: 4.0}
    wide = spark.createDataFrame([(i, 0, float(a), float(b)) for i, (a, b) in
                                  enumerate(zip([1, 1, 2, 3], [1, 2, 2, 5]))],
                                 "id long, y int, a double, b double")
    long = stats.to_long(wide, "id", "y", ["a", "b"])
    rw = stats.rank_wide(long, ["a", "b"], materialize=False)
    rho = stats.spearman_pairs(rw, ["a", "b"]).collect()[0]["rho"]
    assert rho == pytest.approx(0.833333, abs=1e-6)


def test_c7_titles(spark):
    df = spark.createDataFrame([("The Birds",), ("La La Land",), ("Therapy",), (None,)], "t string")
    assert [r[0] for r in df.select(S.title_norm("t")).collect()] == ["birds", "la land", "therapy", ""]


def test_c8_text_fold():
    assert fold_text("AmÃ©lie") == "amelie"
    assert fold_text("Amélie") == "amelie"
    assert fold_text(" É ") == "e"
    assert fold_text("日本") == "日本"
    assert fold_text(None) is None


def test_c9_genres(spark):
    df = spark.createDataFrame([("Drama|Sci-Fi",), (None,), ("(no genres listed)",)], "g string")
    out = enrich.multi_hot_flags(df, "g", enrich.DEFAULT_GENRES).collect()
    assert out[0]["genre_drama"] == 1 and out[0]["genre_sci_fi"] == 1 and out[0]["genre_comedy"] == 0
    assert out[0]["genre_count"] == 2
    assert all(out[1][f"genre_{g.lower().replace('-', '_')}"] == 0 for g in enrich.DEFAULT_GENRES)
    assert out[1]["genre_count"] == 0 and out[2]["genre_count"] == 1
    assert out[2]["genre_drama"] == 0


def test_c10_null_out(spark):
    df = spark.createDataFrame([(7.5, 0.0), (6.0, None), (8.0, 3.0)], "avg double, cnt double")
    df = df.withColumn("lg", F.log1p("cnt"))
    r = df.select(*S.null_out(["avg", "cnt", "lg"], F.col("cnt") < 1)).collect()
    assert (r[0]["avg"], r[0]["cnt"], r[0]["lg"]) == (None, None, None)
    assert r[1]["avg"] == 6.0 and r[2]["avg"] == 8.0


def test_c11_prior_count(spark):
    rows = spark.createDataFrame([(1, "D", "P", 2000), (2, "D", "P", 2001), (3, "D", "P", 2001),
                                  (4, "D", "P", 2005)], "e int, d string, p string, t int")
    out = {r["e"]: r["prior"] for r in joins.prior_count(rows, ["d", "p"], "t").collect()}
    assert out == {1: 0, 2: 1, 3: 1, 4: 3}


def test_c12_band_join(spark):
    left = spark.createDataFrame([("x", 2000)], "t string, y int")
    lk = spark.createDataFrame([("x", 1990, 1), ("x", 2001, 9)], "lt string, ly int, r int")
    assert joins.band_join(left, lk, "t", "y", "lt", "ly", "r").collect()[0]["matched_rank"] == 9
    lk2 = spark.createDataFrame([("x", None, 4)], "lt string, ly int, r int")
    assert joins.band_join(left, lk2, "t", "y", "lt", "ly", "r").collect()[0]["matched_rank"] is None
    assert joins.band_join(left, lk2, "t", "y", "lt", "ly", "r",
                           null_year_matches=True).collect()[0]["matched_rank"] == 4


def test_c13_threshold_sweep(spark):
    sc = spark.createDataFrame([(0.35, 0), (0.45, 1), (0.55, 1), (0.65, 1)], "p double, y int")
    out = model.threshold_sweep(sc).collect()
    best = [r for r in out if r["is_best"] == 1][0]
    assert best["t_pct"] == 36 and best["accuracy"] == 1.0
    acc = {r["t_pct"]: r["accuracy"] for r in out}
    assert acc[35] == 0.75 and len(acc) == 41


def test_c14_redundancy_prune(spark):
    assert stats.redundancy_prune(["a", "b"], [("a", "b")], {"a": 0.1, "b": 0.2}) == ["b"]
    assert stats.redundancy_prune(["a", "b"], [("b", "a")], {"a": 0.2, "b": 0.2}) == ["a"]
    assert stats.redundancy_prune(["a", "b"], [], {"a": 0.1, "b": 0.2}) == ["a", "b"]
    # a falls to b first, so its conflict with c no longer counts
    assert stats.redundancy_prune(["a", "b", "c"], [("a", "c"), ("a", "b")],
                                  {"a": 0.1, "b": 0.2, "c": 0.05}) == ["b", "c"]
    ranks = spark.createDataFrame([(1.0, 1.0, 3.0), (2.0, 2.0, 1.0), (3.0, 3.5, 2.0)], "a double, b double, c double")
    assert stats.conflicts(ranks, ["a", "b", "c"], 0.85) == [("a", "b")]


def test_c15_tag_slug(spark):
    assert S.slug_name("oscar (best picture)", "mltag_") == "mltag_oscar_best_picture"
    assert S.slug_name("feel-good", "mltag_") == "mltag_feel_good"
    df = spark.createDataFrame([("oscar (best picture)",), ("feel-good",)], "t string")
    assert [r[0] for r in df.select(S.slug("t", "mltag_")).collect()] == \
        ["mltag_oscar_best_picture", "mltag_feel_good"]


def test_c16_leak_free_out_of_fold(spark):
    import random
    rnd = random.Random(7)
    ents = [(i, rnd.randint(0, 1), i % 5) for i in range(200)]
    bridge = spark.createDataFrame([(i, rnd.randint(0, 15)) for i in range(200) for _ in range(3)],
                                   "e long, p long")
    base = spark.createDataFrame(ents, "e long, y int, f int")
    flipped = spark.createDataFrame([(e, 1 - y if f == 2 else y, f) for e, y, f in ents],
                                    "e long, y int, f int")
    a = {r["e"]: r["enc"] for r in encode.out_of_fold_encode(base, bridge, "e", "p", "y", "f", "enc").collect()}
    b = {r["e"]: r["enc"] for r in encode.out_of_fold_encode(flipped, bridge, "e", "p", "y", "f", "enc").collect()}
    fold2 = [e for e, _, f in ents if f == 2]
    assert all(math.isclose(a[e], b[e], abs_tol=1e-12) for e in fold2)
    assert any(not math.isclose(a[e], b[e], abs_tol=1e-12) for e, _, f in ents if f != 2)


def test_keep_first_ignores_session_time_zone(spark):
    import datetime
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(1, datetime.datetime(2021, 3, 14, 2, 30), "a"),
                                    (1, datetime.datetime(2021, 3, 14, 3, 15), "b")],
                                   "k int, ts timestamp_ntz, v string")
        assert clean.dedup_first(df, ["k"], [("ts", "desc")]).collect()[0]["v"] == "b"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
