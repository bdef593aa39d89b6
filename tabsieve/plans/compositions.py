"""Queries: the reference's enrichment sources as whole compositions — awards,
test scores, community ratings, both kinds of curated lists and prior
collaborations.

Bindings: awards = lineitem (film = part, won by return flag); score records
and community metadata = orders per customer, as text with junk; curated lists
= parts of Brand#1 with gaps in their years; films with credits = orders.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import enrich, joins
from .enrichment import SELECTED_DIMS, USER_STATS_CTE, tag_tables
from .joining import CREW_CTE, crew_strings
from .tables import r6, table


def award_features(spark, sf):
    won = F.when(F.col("l_returnflag") == "R", "True").when(F.col("l_returnflag") == "A", "1").otherwise("no")
    awards = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("imdb_id"), won.alias("winner"))
    return enrich.award_features(awards)[0]


AWARD_FEATURES_SQL = """
SELECT printf('tt%07d', l_partkey) AS tconst, count(*) AS oscar_nominations,
       CAST(count(*) FILTER (WHERE l_returnflag IN ('R', 'A')) AS BIGINT) AS oscar_wins
FROM lineitem GROUP BY l_partkey"""


def test_scores(spark, sf):
    k = F.col("o_orderkey")
    rating = F.when(k % 7 == 0, "none").otherwise((k % 4).cast("string"))
    return enrich.test_score_features(table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("imdbid"), rating.alias("rating")))


TEST_SCORES_SQL = """
SELECT printf('tt%07d', o_custkey) AS tconst,
       CAST(min(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 4 END) AS INTEGER) AS bechdel_score,
       CASE WHEN min(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE o_orderkey % 4 END) = 3 THEN 1 ELSE 0 END AS bechdel_pass
FROM orders GROUP BY o_custkey"""


def community_ratings(spark, sf):
    k = F.col("o_orderkey")
    meta = table(spark, sf, "orders").select(
        F.concat(F.lit("tt"), F.col("o_custkey").cast("string"), F.lit(" ")).alias("imdb_id"),
        F.when(k % 6 == 0, "n/a").otherwise(F.concat((k % 10).cast("string"), F.lit(".5"))).alias("vote_average"),
        F.when(k % 9 == 0, "0").when(k % 11 == 0, "").otherwise((k % 1000).cast("string")).alias("vote_count"))
    out = enrich.community_ratings(meta)
    return out.select("tconst", "tmdb_vote_avg", "tmdb_vote_count", r6("tmdb_log_votes"))


COMMUNITY_RATINGS_SQL = """
WITH m AS (SELECT 'tt' || o_custkey AS tconst,
             CASE WHEN o_orderkey % 6 <> 0 THEN CAST(o_orderkey % 10 AS DOUBLE) + 0.5 END AS a,
             CASE WHEN o_orderkey % 9 = 0 THEN 0.0 WHEN o_orderkey % 11 = 0 THEN NULL
                  ELSE CAST(o_orderkey % 1000 AS DOUBLE) END AS c FROM orders),
n AS (SELECT tconst, CASE WHEN c < 1 THEN NULL ELSE a END AS a, CASE WHEN c < 1 THEN NULL ELSE c END AS c FROM m),
r AS (SELECT *, row_number() OVER (PARTITION BY tconst ORDER BY
        (CASE WHEN a IS NULL THEN 1 ELSE 0 END) + (CASE WHEN c IS NULL THEN 2 ELSE 0 END),
        a NULLS FIRST, c NULLS FIRST) AS rn FROM n)
SELECT tconst, a AS tmdb_vote_avg, c AS tmdb_vote_count, round(ln(c + 1), 6) AS tmdb_log_votes FROM r WHERE rn = 1"""


def _curated(spark, sf, unmatched):
    p = table(spark, sf, "part")
    films = p.select("p_partkey", F.concat(F.lit("The "), "p_name").alias("title"), "p_size")
    lists = p.where(F.col("p_brand") == "Brand#1").select(
        F.upper("p_name").alias("title"),
        F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.concat(F.col("p_size").cast("string"), F.lit(".0"))).alias("year"),
        F.when(F.col("p_partkey") % 13 == 0, "-").otherwise(F.col("p_partkey").cast("string")).alias("rank"))
    return joins.curated_list_features(films, lists, "p_partkey", "title", "p_size", null_year_matches=True,
                                       unmatched=unmatched)


def curated_list(spark, sf):
    """A ranked list: unmatched films rank behind its last."""
    return _curated(spark, sf, None)


def curated_collection(spark, sf):
    """A collection: unmatched films have 0."""
    return _curated(spark, sf, 0)


def _curated_sql(fill: str) -> str:
    norm = "coalesce(regexp_replace(trim(lower({})), '^(the|a|an|le|la|les|il|lo|die) ', ''), '')"
    return f"""
WITH lk AS (SELECT {norm.format("upper(p_name)")} AS t, CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS y, p_partkey AS r
            FROM part WHERE p_brand = 'Brand#1' AND p_partkey % 13 <> 0),
f AS (SELECT p_partkey, {norm.format("'The ' || p_name")} AS t, p_size AS y FROM part),
c AS (SELECT f.p_partkey, lk.r, row_number() OVER (PARTITION BY f.p_partkey
             ORDER BY CASE WHEN lk.y IS NULL THEN 1 ELSE 0 END, abs(f.y - lk.y), lk.r) AS rn
      FROM f JOIN lk ON lk.t = f.t AND (lk.y IS NULL OR abs(f.y - lk.y) <= 2))
SELECT f.p_partkey, CAST(coalesce(c.r, {fill}) AS BIGINT) AS list_rank, CASE WHEN c.r IS NULL THEN 0 ELSE 1 END AS in_list
FROM f LEFT JOIN c ON c.p_partkey = f.p_partkey AND c.rn = 1"""


def prior_collaborations(spark, sf):
    year = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    return enrich.prior_collaborations(crew_strings(spark, sf).join(year, "o_orderkey"), key="o_orderkey")


PRIOR_COLLABORATIONS_SQL = "WITH " + CREW_CTE + """,
y AS (SELECT o_orderkey, year(o_orderdate) AS t FROM orders),
a AS (SELECT o_orderkey, unnest(directors) AS l, dps FROM roles),
pairs AS (SELECT t, l, p, count(*) AS n FROM (SELECT o_orderkey, l, unnest(dps) AS p FROM a) JOIN y USING (o_orderkey)
          GROUP BY t, l, p),
mine AS (SELECT o_orderkey, directors[1] AS l, unnest(list_distinct(dps)) AS p FROM roles WHERE len(directors) > 0),
s AS (SELECT mine.o_orderkey, sum(pairs.n) AS n FROM mine JOIN y USING (o_orderkey)
      JOIN pairs ON pairs.l = mine.l AND pairs.p = mine.p AND pairs.t < y.t GROUP BY mine.o_orderkey)
SELECT o.o_orderkey, CAST(coalesce(s.n, 0) AS INTEGER) AS dir_dp_collabs
FROM orders o LEFT JOIN s ON s.o_orderkey = o.o_orderkey"""

GENRES = ["BUILDING", "Drama", "MACHINERY"]


def external_features(spark, sf):
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    links = c.select(k.alias("movieId"), F.when(k % 10 == 0, "").otherwise(k.cast("string")).alias("imdbId"))
    movies = c.select(k.alias("movieId"), F.concat("c_mktsegment", F.when(k % 3 == 0, "|Drama").otherwise("")).alias("genres"))
    ev = table(spark, sf, "events").withColumnRenamed("user_id", "movieId").withColumnRenamed("value", "rating")
    cells, tags = tag_tables(spark, sf)
    out, _ = enrich.external_features(
        links, movies, ev, ev.where("event_type = 'click'"),
        cells.select(F.col("vec_id").alias("movieId"), F.col("tag_id").alias("tagId"), "relevance"),
        tags.select(F.col("tag_id").alias("tagId"), "tag"), GENRES, SELECTED_DIMS)
    return out.select(*[r6(c) if t == "double" else c for c, t in out.dtypes])


EXTERNAL_FEATURES_SQL = "WITH " + USER_STATS_CTE + """,
l AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS d, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
pk AS (SELECT vec_id, """ + ", ".join(f"max(v) FILTER (WHERE d = {d}) AS mltag_dim_{d}_x" for d in (3, 7, 12, 40, 63)) + """
       FROM l GROUP BY vec_id),
c AS (SELECT c_custkey, c_mktsegment || CASE WHEN c_custkey % 3 = 0 THEN '|Drama' ELSE '' END AS g FROM customer)
SELECT printf('tt%07d', c_custkey) AS tconst, """ + ", ".join(
    f"CASE WHEN contains(g, '{g}') THEN 1 ELSE 0 END AS genre_{g.lower()}" for g in GENRES) + """,
  CAST(len(string_split(g, '|')) AS INTEGER) AS genre_count, round(ml_rating_mean, 6) AS ml_rating_mean,
  round(ml_rating_std, 6) AS ml_rating_std, ml_rating_count, round(ml_rating_median, 6) AS ml_rating_median,
  round(ml_log_count, 6) AS ml_log_count, coalesce(ml_tag_count, 0) AS ml_tag_count,
  """ + ", ".join(f"round(mltag_dim_{d}_x, 6) AS mltag_dim_{d}_x" for d in (3, 7, 12, 40, 63)) + """
FROM c LEFT JOIN us ON us.user_id = c.c_custkey LEFT JOIN pk ON pk.vec_id = c.c_custkey WHERE c_custkey % 10 <> 0"""

QUERIES = {
    "external_features": (external_features, EXTERNAL_FEATURES_SQL),
    "award_features": (award_features, AWARD_FEATURES_SQL),
    "test_scores": (test_scores, TEST_SCORES_SQL),
    "community_ratings": (community_ratings, COMMUNITY_RATINGS_SQL),
    "curated_list": (curated_list, _curated_sql("(SELECT max(r) FROM lk) + 1")),
    "curated_collection": (curated_collection, _curated_sql("0")),
    "prior_collaborations": (prior_collaborations, PRIOR_COLLABORATIONS_SQL),
}
