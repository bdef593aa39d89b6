"""Queries: rating stats, multi-hot, selected-tag pivot, full-outer merge,
left enrichment with fills, match rate, grouped wins.

Bindings: ratings facts = events(user_id, value), tag facts = click events;
genres = words of part.p_name; tag matrix = embeddings exploded (dimension d is
tag "Dim-d (x)"); films = orders keyed to users by o_custkey.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich
from .tables import r6, table

GENRE_WORDS = ["anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large", "new",
               "old", "plate", "red", "ring", "rod", "small", "widget"]
SELECTED_DIMS = ["Dim-3 (x)", "dim-7 (X)", "DIM-12 (x)", "Dim-40 (x)", "Dim-63 (x)",
                 "Dim-99 (x)"]  # the last one matches nothing and is reported


def user_stats(spark, sf):
    ev = table(spark, sf, "events")
    st = enrich.fact_stats(ev, "user_id", "value", prefix="ml_rating")
    tags = enrich.count_per_key(ev.where(F.col("event_type") == "click"), "user_id",
                                "ml_tag_count")
    return st.join(tags, "user_id", "left").withColumn(
        "ml_tag_count", F.coalesce(F.col("ml_tag_count"), F.lit(0)))


def rating_stats(spark, sf):
    s = user_stats(spark, sf)
    return s.select("user_id", r6("ml_rating_mean"), r6("ml_rating_std"), "ml_rating_count",
                    r6("ml_rating_median"), r6("ml_log_count"), "ml_tag_count")


USER_STATS_CTE = """
us AS (SELECT user_id, avg(value) AS ml_rating_mean, coalesce(stddev_samp(value), 0) AS ml_rating_std,
              count(value) AS ml_rating_count, median(value) AS ml_rating_median,
              ln(count(value) + 1) AS ml_log_count,
              count(*) FILTER (WHERE event_type = 'click') AS ml_tag_count
       FROM events GROUP BY user_id)"""

RATING_STATS_SQL = "WITH " + USER_STATS_CTE + """
SELECT user_id, round(ml_rating_mean, 6) AS ml_rating_mean, round(ml_rating_std, 6) AS ml_rating_std,
       ml_rating_count, round(ml_rating_median, 6) AS ml_rating_median,
       round(ml_log_count, 6) AS ml_log_count, ml_tag_count FROM us"""


def multi_hot(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    out = enrich.multi_hot_flags(p, "p_name", GENRE_WORDS, prefix="genre_", sep=" ")
    return out.drop("p_name")


MULTI_HOT_SQL = "SELECT p_partkey, " + ", ".join(
    f"CASE WHEN list_contains(string_split(p_name, ' '), '{w}') THEN 1 ELSE 0 END AS genre_{w}"
    for w in GENRE_WORDS) + """,
  CAST(coalesce(length(p_name) - length(replace(p_name, ' ', '')) + 1, 0) AS INTEGER) AS genre_count
FROM part"""


def tag_tables(spark, sf):
    emb = table(spark, sf, "embeddings")
    long = emb.select("vec_id", F.posexplode("embedding").alias("tag_id", "relevance")) \
        .withColumn("relevance", F.col("relevance").cast("double"))
    tags = long.select("tag_id").distinct().withColumn(
        "tag", F.concat(F.lit("Dim-"), F.col("tag_id").cast("string"), F.lit(" (x)")))
    return long, tags


def pivot_selected(spark, sf):
    long, tags = tag_tables(spark, sf)
    wide, _missing = enrich.pivot_selected(long, tags, "vec_id", "tag_id", "tag", "relevance",
                                           SELECTED_DIMS)
    return wide.select("vec_id", *[r6(c) for c in wide.columns if c != "vec_id"])


PIVOT_SELECTED_SQL = """
WITH l AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS tag_id,
                  CAST(unnest(embedding) AS DOUBLE) AS relevance FROM embeddings)
SELECT vec_id,
  round(max(CASE WHEN tag_id = 3 THEN relevance END), 6) AS mltag_dim_3_x,
  round(max(CASE WHEN tag_id = 7 THEN relevance END), 6) AS mltag_dim_7_x,
  round(max(CASE WHEN tag_id = 12 THEN relevance END), 6) AS mltag_dim_12_x,
  round(max(CASE WHEN tag_id = 40 THEN relevance END), 6) AS mltag_dim_40_x,
  round(max(CASE WHEN tag_id = 63 THEN relevance END), 6) AS mltag_dim_63_x
FROM l WHERE tag_id IN (3, 7, 12, 40, 63) GROUP BY vec_id"""


def outer_features(spark, sf):
    ev = enrich.count_per_key(table(spark, sf, "events"), "user_id", "n_events") \
        .withColumnRenamed("user_id", "cust")
    od = enrich.count_per_key(table(spark, sf, "orders"), "o_custkey", "n_orders") \
        .withColumnRenamed("o_custkey", "cust")
    return enrich.outer_merge(ev, od, "cust")


OUTER_FEATURES_SQL = """
SELECT coalesce(a.cust, b.cust) AS cust, a.n_events, b.n_orders FROM
  (SELECT user_id AS cust, count(*) AS n_events FROM events GROUP BY user_id) a
FULL OUTER JOIN
  (SELECT o_custkey AS cust, count(*) AS n_orders FROM orders GROUP BY o_custkey) b ON a.cust = b.cust"""


def _films(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))


def enrich_left(spark, sf):
    feats = user_stats(spark, sf).select("user_id", "ml_rating_mean", "ml_rating_count",
                                         "ml_tag_count")
    out = enrich.enrich_left(_films(spark, sf), feats, "user_id",
                             {"ml_rating_mean": "median", "ml_rating_count": 0,
                              "ml_tag_count": 0})
    return out.select("o_orderkey", r6("ml_rating_mean"), "ml_rating_count", "ml_tag_count")


ENRICH_LEFT_SQL = "WITH " + USER_STATS_CTE + """,
j AS (SELECT o.o_orderkey, us.ml_rating_mean, us.ml_rating_count, us.ml_tag_count
      FROM orders o LEFT JOIN us ON us.user_id = o.o_custkey)
SELECT o_orderkey,
  round(coalesce(ml_rating_mean, (SELECT median(ml_rating_mean) FROM j)), 6) AS ml_rating_mean,
  coalesce(ml_rating_count, 0) AS ml_rating_count, coalesce(ml_tag_count, 0) AS ml_tag_count
FROM j"""


def match_rate(spark, sf):
    feats = user_stats(spark, sf).select("user_id", "ml_rating_mean")
    j = _films(spark, sf).join(feats, "user_id", "left")
    rep = enrich.match_report(j, F.col("ml_rating_mean").isNotNull())
    return rep.select("n_rows", "n_matched", r6("match_rate"))


MATCH_RATE_SQL = """
SELECT count(*) AS n_rows, count(u.user_id) AS n_matched,
       round(count(u.user_id) / count(*), 6) AS match_rate
FROM orders o LEFT JOIN (SELECT DISTINCT user_id FROM events) u ON u.user_id = o.o_custkey"""


def grouped_wins(spark, sf):
    li = table(spark, sf, "lineitem")
    won = F.when(F.col("l_returnflag") == "R", F.lit("True")) \
        .when(F.col("l_returnflag") == "A", F.lit("1")).otherwise(F.lit("no"))
    agg = enrich.grouped_flags(li.select("l_partkey", won.alias("winner")), "l_partkey",
                               F.col("winner")).withColumnRenamed("l_partkey", "p_partkey")
    parts = table(spark, sf, "part").select("p_partkey")
    return enrich.enrich_left(parts, agg, "p_partkey",
                              {"oscar_nominations": 0, "oscar_wins": 0})


GROUPED_WINS_SQL = """
SELECT p.p_partkey, coalesce(a.n, 0) AS oscar_nominations, CAST(coalesce(a.w, 0) AS BIGINT) AS oscar_wins
FROM part p LEFT JOIN (
  SELECT l_partkey, count(*) AS n,
         sum(CASE WHEN lower(CASE l_returnflag WHEN 'R' THEN 'True' WHEN 'A' THEN '1' ELSE 'no' END)
                  IN ('true', '1', 'yes') THEN 1 ELSE 0 END) AS w
  FROM lineitem GROUP BY l_partkey) a ON a.l_partkey = p.p_partkey"""

QUERIES = {
    "rating_stats": (rating_stats, RATING_STATS_SQL),
    "multi_hot": (multi_hot, MULTI_HOT_SQL),
    "pivot_selected": (pivot_selected, PIVOT_SELECTED_SQL),
    "outer_features": (outer_features, OUTER_FEATURES_SQL),
    "enrich_left": (enrich_left, ENRICH_LEFT_SQL),
    "match_rate": (match_rate, MATCH_RATE_SQL),
    "grouped_wins": (grouped_wins, GROUPED_WINS_SQL),
}
