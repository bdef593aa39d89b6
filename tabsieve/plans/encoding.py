"""Queries: smoothed target encoding, out-of-fold encoding, stratified folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode
from .tables import movies, part_bridge, r6, supplier_bridge


def prestige(spark, sf):
    mv = movies(spark, sf)
    train = mv.where("is_train").select(F.col("o_orderkey"), "y")
    target = mv.select("o_orderkey")
    out = encode.target_encode(train, target, supplier_bridge(spark, sf).withColumnRenamed(
        "l_orderkey", "o_orderkey"), "o_orderkey", "l_suppkey", "y",
        "director_prestige", "n_directors")
    out = encode.target_encode(train, out, part_bridge(spark, sf).withColumnRenamed(
        "l_orderkey", "o_orderkey"), "o_orderkey", "l_partkey", "y",
        "writer_prestige", "n_writers")
    return out.select("o_orderkey", r6("director_prestige"), r6("writer_prestige"),
                      "n_directors", "n_writers")


PRESTIGE_SQL = """
WITH mv AS (SELECT o_orderkey AS e, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y
            FROM orders WHERE o_orderkey % 10 < 8),
bd AS (SELECT l_orderkey AS e, l_suppkey AS p FROM lineitem),
bw AS (SELECT l_orderkey AS e, l_partkey AS p FROM lineitem),
jd AS (SELECT bd.p, mv.y FROM mv JOIN bd ON mv.e = bd.e),
jw AS (SELECT bw.p, mv.y FROM mv JOIN bw ON mv.e = bw.e),
gd AS (SELECT avg(y) AS gm FROM jd),
gw AS (SELECT avg(y) AS gm FROM jw),
sd AS (SELECT p, (sum(y) + 20 * (SELECT gm FROM gd)) / (count(*) + 20) AS s FROM jd GROUP BY p),
sw AS (SELECT p, (sum(y) + 20 * (SELECT gm FROM gw)) / (count(*) + 20) AS s FROM jw GROUP BY p),
md AS (SELECT bd.e, avg(coalesce(sd.s, (SELECT gm FROM gd))) AS v, count(*) AS n
       FROM bd LEFT JOIN sd ON bd.p = sd.p GROUP BY bd.e),
mw AS (SELECT bw.e, avg(coalesce(sw.s, (SELECT gm FROM gw))) AS v, count(*) AS n
       FROM bw LEFT JOIN sw ON bw.p = sw.p GROUP BY bw.e)
SELECT o.o_orderkey,
       round(coalesce(md.v, (SELECT gm FROM gd)), 6) AS director_prestige,
       round(coalesce(mw.v, (SELECT gm FROM gw)), 6) AS writer_prestige,
       CAST(coalesce(md.n, 1) AS BIGINT) AS n_directors,
       CAST(coalesce(mw.n, 1) AS BIGINT) AS n_writers
FROM orders o LEFT JOIN md ON md.e = o.o_orderkey LEFT JOIN mw ON mw.e = o.o_orderkey
"""


def prestige_oof(spark, sf):
    mv = movies(spark, sf).select("o_orderkey", "y", "fold")
    br = supplier_bridge(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey")
    out = encode.out_of_fold_encode(mv, br, "o_orderkey", "l_suppkey", "y", "fold",
                                    "director_prestige")
    return out.select("o_orderkey", "fold", r6("director_prestige"))


PRESTIGE_OOF_SQL = """
WITH mv AS (SELECT o_orderkey AS e, o_orderkey % 5 AS f,
                   CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders),
br AS (SELECT l_orderkey AS e, l_suppkey AS p FROM lineitem),
folds AS (SELECT DISTINCT f AS hold FROM mv),
jd AS (SELECT folds.hold, br.p, mv.y FROM folds JOIN mv ON mv.f <> folds.hold
       JOIN br ON br.e = mv.e),
gm AS (SELECT hold, avg(y) AS gm FROM jd GROUP BY hold),
ps AS (SELECT jd.hold, jd.p, (sum(jd.y) + 20 * any_value(gm.gm)) / (count(*) + 20) AS s
       FROM jd JOIN gm ON gm.hold = jd.hold GROUP BY jd.hold, jd.p),
em AS (SELECT mv.e, avg(coalesce(ps.s, gm.gm)) AS v
       FROM mv JOIN br ON br.e = mv.e JOIN gm ON gm.hold = mv.f
       LEFT JOIN ps ON ps.hold = mv.f AND ps.p = br.p GROUP BY mv.e)
SELECT mv.e AS o_orderkey, mv.f AS fold, round(coalesce(em.v, gm.gm), 6) AS director_prestige
FROM mv JOIN gm ON gm.hold = mv.f LEFT JOIN em ON em.e = mv.e
"""


def stratified_folds(spark, sf):
    mv = movies(spark, sf).select("o_orderkey", "y")
    return encode.stratified_folds(mv, "o_orderkey", "y", k=5)


STRATIFIED_FOLDS_SQL = """
SELECT o_orderkey, y,
       CAST((row_number() OVER (PARTITION BY y ORDER BY md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) - 1) % 5 AS INTEGER) AS fold
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y FROM orders)
"""

QUERIES = {
    "prestige": (prestige, PRESTIGE_SQL),
    "prestige_oof": (prestige_oof, PRESTIGE_OOF_SQL),
    "stratified_folds": (stratified_folds, STRATIFIED_FOLDS_SQL),
}
