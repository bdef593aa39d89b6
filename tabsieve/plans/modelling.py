"""Queries: feature matrix, forest predictions, cross-validation summary,
threshold sweep and ordered predictions for the held-out split.

Binding: entities = orders (y = status 'F'), features = the cleaning output
plus leak-free crew-style encodings from the supplier and part bridges,
stratified folds on the training split (o_orderkey % 10 < 8); the held-out
split (the rest) is scored in file order.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode
from ..operators import model as M
from .cleaning import IMPUTED_CTE, imputed_movies
from .encoding import PRESTIGE_OOF_SQL, PRESTIGE_SQL, prestige_oof
from ..session import cut_lineage
from .tables import movies, part_bridge, r6, supplier_bridge, table
from ..operators import clean

BASE_FEATURES = ["runtime", "log_votes", "film_age", "votes_per_minute", "runtime_short",
                 "votes_x_runtime", "is_foreign"]


def derived(spark, sf):
    d = clean.derive_features(imputed_movies(spark, sf), primary="primary_title",
                              original="original_title")
    return d.select("o_orderkey", *BASE_FEATURES)


def feature_matrix(spark, sf):
    d = derived(spark, sf)
    feats = M.select_features(d.columns)
    fm = M.feature_matrix(d, ["o_orderkey"], feats)
    return fm.select("o_orderkey", *[r6(c) for c in feats])


FEATURE_MATRIX_SQL = "WITH " + IMPUTED_CTE + """
SELECT o_orderkey,
  round(coalesce(CAST(runtime AS DOUBLE), 0.0), 6) AS runtime,
  round(coalesce(ln(votes + 1), 0.0), 6) AS log_votes,
  round(coalesce(CAST(CASE WHEN year IS NULL THEN NULL ELSE greatest(2026 - year, 1) END AS DOUBLE), 0.0), 6) AS film_age,
  round(coalesce(votes / greatest(runtime, 1), 0.0), 6) AS votes_per_minute,
  round(CAST(CASE WHEN runtime < 90 THEN 1 ELSE 0 END AS DOUBLE), 6) AS runtime_short,
  round(coalesce(ln(votes + 1) * runtime, 0.0), 6) AS votes_x_runtime,
  round(CAST(CASE WHEN original_title IS NOT NULL AND original_title <> '' AND original_title <> primary_title
       THEN 1 ELSE 0 END AS DOUBLE), 6) AS is_foreign
FROM imp"""


def _features(spark, sf):
    return M.feature_matrix(derived(spark, sf), ["o_orderkey"], BASE_FEATURES)


def _training_table(spark, sf, features=None):
    mv = movies(spark, sf).where("is_train").select("o_orderkey", "y")
    mv = encode.stratified_folds(mv, "o_orderkey", "y", k=5)
    d = _features(spark, sf) if features is None else features
    return mv.join(d, "o_orderkey", "left")


def _encoder(spark, sf):
    bs = supplier_bridge(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    bp = part_bridge(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    return M.SmoothedEncoder(
        bridges=[(bs, "l_suppkey", "director_prestige", "n_directors"),
                 (bp, "l_partkey", "writer_prestige", "n_writers")],
        entityCol="o_orderkey", labelCol="y", k=20.0)


MODEL_FEATURES = BASE_FEATURES + ["director_prestige", "writer_prestige", "n_directors",
                                  "n_writers"]


def _fit_final(spark, sf, num_trees=30, max_depth=8, features=None):
    data = cut_lineage(_training_table(spark, sf, features))  # read by both encoders and their application
    pipe = M.forest_pipeline(_encoder(spark, sf), MODEL_FEATURES, "y", num_trees, max_depth)
    return pipe.fit(data)


def rf_predict(spark, sf):
    feats = cut_lineage(_features(spark, sf))  # for the training rows and for all
    model = _fit_final(spark, sf, features=feats)
    allrows = movies(spark, sf).select("o_orderkey", "y").join(feats, "o_orderkey", "left")
    scored = model.transform(allrows)
    return scored.select("o_orderkey", r6(M.positive_probability(scored), "p_positive"),
                         F.col("prediction").cast("int").alias("prediction"))


def encoded_iterations(spark, sf):
    """(o_orderkey, fold, y, features..., encodings <name>__<i> of the i-th fold's
    iteration, counts) from one pass over each bridge.  The training table is
    read by both encoders and the final join, so it is written once."""
    data = cut_lineage(_training_table(spark, sf))
    lab = data.select("o_orderkey", "y", "fold")
    bs = supplier_bridge(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    bp = part_bridge(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    ed = encode.fold_iteration_encode(lab, bs, "o_orderkey", "l_suppkey", "y", "fold",
                                      "director_prestige", "n_directors", wide=True)
    ew = encode.fold_iteration_encode(lab, bp, "o_orderkey", "l_partkey", "y", "fold",
                                      "writer_prestige", "n_writers", wide=True)
    return ed.join(ew, "o_orderkey").join(data, "o_orderkey")


def cv_summary(spark, sf):
    pipe = M.forest_pipeline(None, MODEL_FEATURES, "y", num_trees=10, max_depth=6, cut=False)
    acc = M.cross_validate_encoded(pipe, encoded_iterations(spark, sf), "fold", "y",
                                   wide=["director_prestige", "writer_prestige"])
    return M.cv_summary(acc)


def threshold_sweep(spark, sf):
    oof = prestige_oof(spark, sf)
    y = movies(spark, sf).select("o_orderkey", "y")
    scored = oof.join(y, "o_orderkey").select(F.col("director_prestige").alias("p"), "y")
    sw = M.threshold_sweep(scored, "p", "y", 30, 70)
    return sw.select("t_pct", r6("accuracy"), "is_best")


THRESHOLD_SWEEP_SQL = "WITH oof AS (" + PRESTIGE_OOF_SQL + """),
s AS (SELECT oof.director_prestige AS p, CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END AS y
      FROM oof JOIN orders o ON o.o_orderkey = oof.o_orderkey),
f0 AS (SELECT p, y, CAST(floor(p * 100) AS INTEGER) AS f FROM s),
f1 AS (SELECT y, CASE WHEN p < f / 100.0 THEN f - 1 WHEN p >= (f + 1) / 100.0 THEN f + 1 ELSE f END AS f FROM f0),
cnt AS (SELECT least(greatest(f - 29, 0), 41) AS b, sum(y) AS pos, sum(1 - y) AS neg FROM f1 GROUP BY 1),
grid AS (SELECT CAST(range AS INTEGER) AS t_pct FROM range(30, 71)),
acc AS (SELECT g.t_pct, coalesce(sum(c.pos), 0) AS tp, coalesce(sum(c.neg), 0) AS fp
        FROM grid g LEFT JOIN cnt c ON c.b >= g.t_pct - 29 GROUP BY g.t_pct),
tot AS (SELECT sum(pos) AS pp, sum(neg) AS nn FROM cnt)
SELECT t_pct, round((tp + (nn - fp)) / (pp + nn), 6) AS accuracy,
       CASE WHEN row_number() OVER (ORDER BY (tp + (nn - fp)) / (pp + nn) DESC, t_pct) = 1 THEN 1 ELSE 0 END AS is_best
FROM acc, tot"""


def predict_ordered(spark, sf):
    """Score the held-out orders in file order (the reference's hidden split):
    the default forest cross-validated, its threshold swept over out-of-fold
    probabilities, refitted on all training rows."""
    fitted = M.train(_training_table(spark, sf), _encoder(spark, sf), MODEL_FEATURES, num_trees=10, max_depth=6)
    hidden = M.with_row_id(table(spark, sf, "orders").select("o_orderkey", "_metadata")) \
        .where(F.col("o_orderkey") % 10 >= 8)
    feats = M.feature_matrix(derived(spark, sf), ["o_orderkey"], BASE_FEATURES)
    return M.predict_in_order(hidden, feats, "o_orderkey", fitted["model"], fitted["threshold"]) \
        .select("o_orderkey", "prediction")


def ordered_scores(spark, sf):
    """Held-out orders in file order with the plain encoding as score and the
    swept threshold: the ordering, join and threshold steps without a learner."""
    hidden = table(spark, sf, "orders").where(F.col("o_orderkey") % 10 >= 8).select("o_orderkey")
    enc = encode.target_encode(movies(spark, sf).where("is_train"), hidden,
                               supplier_bridge(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey"),
                               "o_orderkey", "l_suppkey", "y", "p")
    best = M.best_threshold(prestige_oof(spark, sf).join(movies(spark, sf).select("o_orderkey", "y"), "o_orderkey")
                            .select(F.col("director_prestige").alias("p"), "y"))
    return enc.select("o_orderkey", F.when(r6("p") >= best, "True").otherwise("False").alias("prediction"))


ORDERED_SCORES_SQL = "WITH enc AS (" + PRESTIGE_SQL + "), sweep AS (" + THRESHOLD_SWEEP_SQL + """)
SELECT o_orderkey, CASE WHEN director_prestige >= (SELECT t_pct / 100.0 FROM sweep WHERE is_best = 1)
                        THEN 'True' ELSE 'False' END AS prediction
FROM enc WHERE o_orderkey % 10 >= 8"""


QUERIES = {
    "feature_matrix": (feature_matrix, FEATURE_MATRIX_SQL),
    "rf_predict": (rf_predict, None),
    "cv_summary": (cv_summary, None),
    "threshold_sweep": (threshold_sweep, THRESHOLD_SWEEP_SQL),
    "predict_ordered": (predict_ordered, None),
    "ordered_scores": (ordered_scores, ORDERED_SCORES_SQL),
}
