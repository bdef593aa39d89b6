"""Queries: typed parse, winsorize, bucket-median impute, derived features,
dedup, profiles, ids, labels, null-out, text fold.

The raw "movie CSV" is derived from ``orders`` with injected damage:
``'\\N'`` and junk strings in year/runtime, NULL votes, empty/NULL titles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions import textfold
from ..operators import clean
from .tables import r6, table

SENT = S.NULL_SENTINEL


def raw_movies(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    yr = F.year("o_orderdate")
    price = F.floor("o_totalprice")
    return o.select(
        "o_orderkey",
        F.when(k % 10 == 3, F.lit(SENT)).when(k % 10 == 7, F.lit("abc"))
        .otherwise(yr.cast("string")).alias("year_s"),
        F.when(k % 20 == 3, (yr + 1).cast("string")).otherwise(F.lit(SENT)).alias("end_year_s"),
        F.when(k % 10 == 2, F.lit(SENT)).when(k % 10 == 9, F.lit("junk"))
        .otherwise(F.concat((price % 300).cast("string"), F.lit("."), (k % 10).cast("string")))
        .alias("runtime_s"),
        F.when(k % 10 == 5, F.lit(None)).otherwise(price.cast("string")).alias("votes_s"),
        F.col("o_orderpriority").alias("primary_title"),
        F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit(None))
        .when(k % 4 == 2, F.col("o_orderpriority")).otherwise(F.lower("o_orderpriority"))
        .alias("original_title"),
        F.when(F.col("o_orderstatus") == "F", "True").when(F.col("o_orderstatus") == "O", "False")
        .otherwise("true").alias("label"))


RAW_CTE = r"""
raw AS (
  SELECT o_orderkey,
    CASE o_orderkey % 10 WHEN 3 THEN '\N' WHEN 7 THEN 'abc'
         ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year_s,
    CASE WHEN o_orderkey % 20 = 3 THEN CAST(year(o_orderdate) + 1 AS VARCHAR) ELSE '\N' END AS end_year_s,
    CASE o_orderkey % 10 WHEN 2 THEN '\N' WHEN 9 THEN 'junk'
         ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) % 300 AS VARCHAR) || '.' || CAST(o_orderkey % 10 AS VARCHAR) END AS runtime_s,
    CASE WHEN o_orderkey % 10 = 5 THEN NULL ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS votes_s,
    o_orderpriority AS primary_title,
    CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN o_orderpriority
         ELSE lower(o_orderpriority) END AS original_title,
    CASE o_orderstatus WHEN 'F' THEN 'True' WHEN 'O' THEN 'False' ELSE 'true' END AS label
  FROM orders)"""

TYPED_CTE = RAW_CTE + r""",
typed AS (
  SELECT o_orderkey, primary_title, original_title, label,
    TRY_CAST(round_even(TRY_CAST(NULLIF(year_s, '\N') AS DOUBLE), 0) AS INTEGER) AS year_raw,
    TRY_CAST(round_even(TRY_CAST(NULLIF(end_year_s, '\N') AS DOUBLE), 0) AS INTEGER) AS end_year_raw,
    TRY_CAST(round_even(TRY_CAST(NULLIF(runtime_s, '\N') AS DOUBLE), 0) AS INTEGER) AS runtime_raw,
    TRY_CAST(NULLIF(votes_s, '\N') AS DOUBLE) AS votes_raw
  FROM raw)"""

IMPUTED_CTE = TYPED_CTE + r""",
wz AS (
  SELECT *, coalesce(year_raw, end_year_raw) AS year,
    CAST(floor(coalesce(year_raw, end_year_raw) / 2) * 2 AS INTEGER) AS bk,
    CASE WHEN runtime_raw IS NULL THEN NULL ELSE least(greatest(runtime_raw, 1), 210) END AS runtime_w
  FROM typed),
imp AS (
  SELECT o_orderkey, primary_title, original_title, year,
    coalesce(runtime_w, CAST(round_even(median(CAST(runtime_w AS DOUBLE)) OVER (PARTITION BY bk), 0) AS INTEGER)) AS runtime,
    CASE WHEN coalesce(votes_raw, median(votes_raw) OVER (PARTITION BY bk)) IS NULL THEN NULL
         ELSE least(coalesce(votes_raw, median(votes_raw) OVER (PARTITION BY bk)), 400000) END AS votes
  FROM wz)"""


def typed_movies(spark, sf):
    r = raw_movies(spark, sf)
    return r.select("o_orderkey", "primary_title", "original_title", "label",
                    S.parse_int("year_s").alias("year_raw"),
                    S.parse_int("end_year_s").alias("end_year_raw"),
                    S.parse_int("runtime_s").alias("runtime_raw"),
                    S.parse_double("votes_s").alias("votes_raw"))


def imputed_movies(spark, sf, approx=False):
    t = typed_movies(spark, sf)
    t = t.select("o_orderkey", "primary_title", "original_title",
                 F.coalesce("year_raw", "end_year_raw").alias("year"),
                 S.winsorize("runtime_raw", 1, 210, "keep").alias("runtime"),
                 F.col("votes_raw").alias("votes"))
    return clean.impute_bucket_median(
        t, "year", {"runtime": {"round_int": True},
                    "votes": {"cap": 400000.0, "null_policy": "keep"}},
        width=2, approx=approx)


def messy_parse(spark, sf):
    return typed_movies(spark, sf).select("o_orderkey", "year_raw", "end_year_raw",
                                          "runtime_raw", "votes_raw")


MESSY_PARSE_SQL = "WITH " + TYPED_CTE + """
SELECT o_orderkey, year_raw, end_year_raw, runtime_raw, votes_raw FROM typed"""


def winsorize(spark, sf):
    t = typed_movies(spark, sf)
    return t.select("o_orderkey",
                    S.winsorize("runtime_raw", 1, 210, "keep").alias("runtime"),
                    S.winsorize("runtime_raw", 1, 210, "floor").alias("runtime_coded"))


WINSORIZE_SQL = "WITH " + TYPED_CTE + """
SELECT o_orderkey,
  CASE WHEN runtime_raw IS NULL THEN NULL ELSE least(greatest(runtime_raw, 1), 210) END AS runtime,
  least(greatest(runtime_raw, 1), 210) AS runtime_coded
FROM typed"""


def impute_bucket_median(spark, sf):
    return imputed_movies(spark, sf).select("o_orderkey", "year", "runtime", r6("votes"))


IMPUTE_SQL = "WITH " + IMPUTED_CTE + """
SELECT o_orderkey, year, runtime, round(votes, 6) AS votes FROM imp"""


def derived_features(spark, sf):
    d = clean.derive_features(imputed_movies(spark, sf), primary="primary_title",
                              original="original_title")
    d = d.withColumn("bechdel_pass", S.flag(F.col("runtime") % 4 == 3))
    return d.select("o_orderkey", r6("log_votes"), "film_age", r6("votes_per_minute"),
                    "runtime_short", r6("votes_x_runtime"), "is_foreign", "bechdel_pass")


DERIVED_SQL = "WITH " + IMPUTED_CTE + """
SELECT o_orderkey,
  round(ln(votes + 1), 6) AS log_votes,
  CASE WHEN year IS NULL THEN NULL ELSE greatest(2026 - year, 1) END AS film_age,
  round(votes / greatest(runtime, 1), 6) AS votes_per_minute,
  CASE WHEN runtime < 90 THEN 1 ELSE 0 END AS runtime_short,
  round(ln(votes + 1) * runtime, 6) AS votes_x_runtime,
  CASE WHEN original_title IS NOT NULL AND original_title <> '' AND original_title <> primary_title
       THEN 1 ELSE 0 END AS is_foreign,
  CASE WHEN runtime % 4 = 3 THEN 1 ELSE 0 END AS bechdel_pass
FROM imp"""


def distinct_rows(spark, sf):
    """Whole rows, every one of them there twice."""
    li = table(spark, sf, "lineitem")
    return clean.distinct_rows(li.unionAll(li))


DISTINCT_SQL = "SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem)"


def dedup_key(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber",
                                             "l_shipdate", "l_quantity")
    return clean.dedup_first(li, ["l_partkey"], [("l_shipdate", "desc"),
                                                 ("l_orderkey", "asc"),
                                                 ("l_linenumber", "asc")])


DEDUP_SQL = """
SELECT l_partkey, l_orderkey, l_linenumber, l_shipdate, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey
                               ORDER BY l_shipdate DESC, l_orderkey, l_linenumber) AS rn
  FROM lineitem) WHERE rn = 1"""


def null_profile(spark, sf):
    r = raw_movies(spark, sf)
    return clean.null_profile(r, {
        "null_year": F.nullif("year_s", F.lit(SENT)).isNull(),
        "null_runtime": F.nullif("runtime_s", F.lit(SENT)).isNull(),
        "null_votes": F.col("votes_s").isNull()})


NULL_PROFILE_SQL = "WITH " + RAW_CTE + r"""
SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE NULLIF(year_s, '\N') IS NULL) AS null_year,
  count(*) FILTER (WHERE NULLIF(runtime_s, '\N') IS NULL) AS null_runtime,
  count(*) FILTER (WHERE votes_s IS NULL) AS null_votes
FROM raw"""


def dup_profile(spark, sf):
    return clean.dup_profile(table(spark, sf, "lineitem"), "l_orderkey")


DUP_PROFILE_SQL = """
SELECT count(*) AS n_raw, count(DISTINCT l_orderkey) AS n_unique,
       count(*) // count(DISTINCT l_orderkey) AS dup_factor FROM lineitem"""


def canonical_id(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    raw = F.when(k % 10 == 7, F.lit("x")).when(k % 10 == 3, F.lit(None)) \
        .otherwise((k * 9973).cast("string"))
    return c.select("c_custkey", S.canonical_id(raw).alias("tconst"))


CANONICAL_ID_SQL = """
SELECT c_custkey,
  CASE WHEN regexp_full_match(trim(raw_id), '[0-9]+') THEN printf('tt%07d', CAST(trim(raw_id) AS BIGINT)) END AS tconst
FROM (SELECT c_custkey, CASE c_custkey % 10 WHEN 7 THEN 'x' WHEN 3 THEN NULL
                             ELSE CAST(c_custkey * 9973 AS VARCHAR) END AS raw_id FROM customer)"""


def label_norm(spark, sf):
    return raw_movies(spark, sf).select("o_orderkey", S.label_int("label").alias("label_int"))


LABEL_NORM_SQL = "WITH " + RAW_CTE + """
SELECT o_orderkey, CASE WHEN lower(label) = 'true' THEN 1 ELSE 0 END AS label_int FROM raw"""


def null_out(spark, sf):
    e = table(spark, sf, "events")
    vc = F.when(F.col("event_id") % 7 == 0, F.lit(None)) \
        .otherwise((F.floor("value") % 5).cast("double"))
    t = e.select("event_id", F.col("value").alias("tmdb_vote_avg"), vc.alias("tmdb_vote_count"))
    t = t.withColumn("tmdb_log_votes", F.log1p("tmdb_vote_count"))
    cols = ["tmdb_vote_avg", "tmdb_vote_count", "tmdb_log_votes"]
    out = t.select("event_id", *S.null_out(cols, F.col("tmdb_vote_count") < 1))
    return out.select("event_id", *[r6(c) for c in cols])


NULL_OUT_SQL = """
WITH t AS (SELECT event_id, value AS va,
             CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(CAST(floor(value) AS BIGINT) % 5 AS DOUBLE) END AS vc
           FROM events)
SELECT event_id,
  round(CASE WHEN vc < 1 THEN NULL ELSE va END, 6) AS tmdb_vote_avg,
  round(CASE WHEN vc < 1 THEN NULL ELSE vc END, 6) AS tmdb_vote_count,
  round(CASE WHEN vc < 1 THEN NULL ELSE ln(vc + 1) END, 6) AS tmdb_log_votes
FROM t"""


def text_fold(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", textfold.text_fold("text").alias("title_clean"))


TEXT_FOLD_SQL = """
SELECT doc_id, strip_accents(lower(trim(text, ' ' || chr(9) || chr(10) || chr(13)))) AS title_clean
FROM documents"""

QUERIES = {
    "messy_parse": (messy_parse, MESSY_PARSE_SQL),
    "winsorize": (winsorize, WINSORIZE_SQL),
    "impute_bucket_median": (impute_bucket_median, IMPUTE_SQL),
    "derived_features": (derived_features, DERIVED_SQL),
    "distinct_rows": (distinct_rows, DISTINCT_SQL),
    "dedup_key": (dedup_key, DEDUP_SQL),
    "null_profile": (null_profile, NULL_PROFILE_SQL),
    "dup_profile": (dup_profile, DUP_PROFILE_SQL),
    "canonical_id": (canonical_id, CANONICAL_ID_SQL),
    "label_norm": (label_norm, LABEL_NORM_SQL),
    "null_out": (null_out, NULL_OUT_SQL),
    "text_fold": (text_fold, TEXT_FOLD_SQL),
}
