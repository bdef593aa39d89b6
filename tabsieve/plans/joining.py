"""Queries: band join, prior count, title normalisation, title join, nested
role extraction and pair expansion.

Bindings: titles/years = part.p_name/p_size, lookup = parts of Brand#1 ranked
by p_partkey; collaborations = (customer, supplier) pairs of orders x lineitem
by order day; crew lists = a Python-literal credit list written per order from
its columns; Oscar-style title aggregate = lineitem x part by upper-cased name.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import joins
from .tables import table


def band_join(spark, sf):
    p = table(spark, sf, "part")
    lookup = p.where(F.col("p_brand") == "Brand#1").select(
        F.col("p_name").alias("t"), F.col("p_size").alias("y"), F.col("p_partkey").alias("r"))
    out = joins.band_join(p.select("p_partkey", "p_name", "p_size"), lookup,
                          "p_name", "p_size", "t", "y", "r", tol=2, out_col="tspdt_rank")
    out = out.withColumn("matched", S.flag(F.col("tspdt_rank").isNotNull()))
    out = joins.fill_rank(out, "tspdt_rank", lookup, "r")
    return out.select("p_partkey", "tspdt_rank", "matched")


BAND_JOIN_SQL = """
WITH lk AS (SELECT p_name AS t, p_size AS y, p_partkey AS r FROM part WHERE p_brand = 'Brand#1'),
c AS (SELECT p.p_partkey, lk.r,
             row_number() OVER (PARTITION BY p.p_partkey ORDER BY abs(p.p_size - lk.y), lk.r) AS rn
      FROM part p JOIN lk ON lk.t = p.p_name AND abs(p.p_size - lk.y) <= 2)
SELECT p.p_partkey, coalesce(c.r, (SELECT max(r) FROM lk) + 1) AS tspdt_rank,
       CASE WHEN c.r IS NULL THEN 0 ELSE 1 END AS matched
FROM part p LEFT JOIN c ON c.p_partkey = p.p_partkey AND c.rn = 1"""


def prior_count(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey",
                                          F.to_date("o_orderdate").alias("day"))
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"),
                                             "l_suppkey").distinct()
    rows = li.join(o, "o_orderkey")
    pc = joins.prior_count(rows, ["o_custkey", "l_suppkey"], "day", "prior")
    per_order = pc.groupBy("o_orderkey").agg(F.sum("prior").alias("__p"))
    return (o.select("o_orderkey").join(per_order, "o_orderkey", "left")
            .select("o_orderkey", F.coalesce("__p", F.lit(0)).cast("long").alias("prior_collabs")))


PRIOR_COUNT_SQL = """
WITH c AS (SELECT DISTINCT l.l_orderkey AS e, o.o_custkey AS d, l.l_suppkey AS p,
                  CAST(o.o_orderdate AS DATE) AS day
           FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey),
pr AS (SELECT c1.e, c1.p, count(c2.e) AS n FROM c c1
       LEFT JOIN c c2 ON c2.d = c1.d AND c2.p = c1.p AND c2.day < c1.day
       GROUP BY c1.e, c1.p)
SELECT o.o_orderkey, CAST(coalesce(sum(pr.n), 0) AS BIGINT) AS prior_collabs
FROM orders o LEFT JOIN pr ON pr.e = o.o_orderkey GROUP BY o.o_orderkey"""


def title_norm(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", S.title_norm("text").alias("title_norm"))


TITLE_NORM_SQL = """
SELECT doc_id,
  coalesce(regexp_replace(trim(lower(text)), '^(the|a|an|le|la|les|il|lo|die) ', ''), '') AS title_norm
FROM documents"""


def title_join(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    li = table(spark, sf, "lineitem").select("l_partkey", "l_returnflag")
    films = li.join(p.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey").select(
        F.concat(F.lit(" "), F.upper("p_name")).alias("film"), "l_returnflag")
    agg = films.groupBy(joins.title_key("film").alias("film")).agg(
        F.count(F.lit(1)).alias("oscar_nominations"),
        F.sum(S.flag(F.col("l_returnflag") == "R")).cast("long").alias("oscar_wins"))
    out = joins.title_join(p, agg, "p_name", "film", "left")
    return out.select("p_partkey",
                      F.coalesce("oscar_nominations", F.lit(0)).alias("oscar_nominations"),
                      F.coalesce("oscar_wins", F.lit(0)).alias("oscar_wins"))


TITLE_JOIN_SQL = """
WITH f AS (SELECT lower(trim(' ' || upper(p.p_name))) AS tk, l.l_returnflag
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
a AS (SELECT tk, count(*) AS n, sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS w
      FROM f GROUP BY tk)
SELECT p.p_partkey, coalesce(a.n, 0) AS oscar_nominations, CAST(coalesce(a.w, 0) AS BIGINT) AS oscar_wins
FROM part p LEFT JOIN a ON a.tk = lower(trim(p.p_name))"""


def crew_strings(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")
    c = F.col("o_custkey")

    def entry(job, name):
        return F.concat(F.lit(", {'job': '" + job + "', 'name': "), name, F.lit("}"))

    def q(x):
        return F.concat(F.lit("'"), x.cast("string"), F.lit("'"))

    crew = F.concat(
        F.lit("[{'job': 'Director', 'name': "), q(F.concat(F.lit("C"), c.cast("string"))), F.lit("}"),
        F.when(k % 3 == 0, entry("director", q(F.concat(F.lit("C"), (c + 1).cast("string"))))).otherwise(F.lit("")),
        F.when(k % 4 != 1, entry("Director of Photography", q(F.concat(F.lit("S"), (k % 97).cast("string"))))).otherwise(F.lit("")),
        F.when(k % 5 == 0, entry("DIRECTOR OF PHOTOGRAPHY", q(F.concat(F.lit("S"), (k % 89).cast("string"))))).otherwise(F.lit("")),
        F.when(k % 7 == 0, entry("Director", F.lit("None"))).otherwise(F.lit("")),
        entry("Editor", q(F.concat(F.lit("E"), (k % 13).cast("string")))),
        F.lit("]"))
    return o.select("o_orderkey", crew.alias("crew"))


CREW_CTE = """
cr AS (SELECT o_orderkey, '[{''job'': ''Director'', ''name'': ''C' || CAST(o_custkey AS VARCHAR) || '''}'
    || CASE WHEN o_orderkey % 3 = 0 THEN ', {''job'': ''director'', ''name'': ''C' || CAST(o_custkey + 1 AS VARCHAR) || '''}' ELSE '' END
    || CASE WHEN o_orderkey % 4 <> 1 THEN ', {''job'': ''Director of Photography'', ''name'': ''S' || CAST(o_orderkey % 97 AS VARCHAR) || '''}' ELSE '' END
    || CASE WHEN o_orderkey % 5 = 0 THEN ', {''job'': ''DIRECTOR OF PHOTOGRAPHY'', ''name'': ''S' || CAST(o_orderkey % 89 AS VARCHAR) || '''}' ELSE '' END
    || CASE WHEN o_orderkey % 7 = 0 THEN ', {''job'': ''Director'', ''name'': None}' ELSE '' END
    || ', {''job'': ''Editor'', ''name'': ''E' || CAST(o_orderkey % 13 AS VARCHAR) || '''}]' AS crew
  FROM orders),
ps AS (SELECT o_orderkey, from_json(replace(regexp_replace(crew, ':\\s*None', ': null', 'g'), '''', '"'),
                                    '[{"job": "VARCHAR", "name": "VARCHAR"}]') AS c FROM cr),
roles AS (SELECT o_orderkey,
    list_transform(list_filter(c, lambda x: lower(x.job) = 'director' AND x.name IS NOT NULL), lambda x: x.name) AS directors,
    list_transform(list_filter(c, lambda x: lower(x.job) = 'director of photography' AND x.name IS NOT NULL), lambda x: x.name) AS dps
  FROM ps)"""


def crew_roles(spark, sf):
    cr = crew_strings(spark, sf)
    parsed = joins.parse_crew("crew")
    return cr.select("o_orderkey",
                     joins.names_with_role(parsed, "Director").alias("directors"),
                     joins.names_with_role(parsed, "Director of Photography").alias("dps"))


def nested_role_extract(spark, sf):
    r = crew_roles(spark, sf)
    return r.select("o_orderkey", F.array_join("directors", "|").alias("directors"),
                    F.size("directors").alias("n_directors"),
                    F.array_join("dps", "|").alias("dps"), F.size("dps").alias("n_dps"))


NESTED_ROLE_SQL = "WITH " + CREW_CTE + """
SELECT o_orderkey, array_to_string(directors, '|') AS directors,
       CAST(len(directors) AS INTEGER) AS n_directors,
       array_to_string(dps, '|') AS dps, CAST(len(dps) AS INTEGER) AS n_dps
FROM roles"""


def pair_explode(spark, sf):
    r = crew_roles(spark, sf)
    return joins.pair_explode(r, "directors", "dps", "director", "dp", ["o_orderkey"])


PAIR_EXPLODE_SQL = "WITH " + CREW_CTE + """,
a AS (SELECT o_orderkey, unnest(directors) AS director, dps FROM roles)
SELECT o_orderkey, director, unnest(dps) AS dp FROM a"""

QUERIES = {
    "band_join": (band_join, BAND_JOIN_SQL),
    "prior_count": (prior_count, PRIOR_COUNT_SQL),
    "title_norm": (title_norm, TITLE_NORM_SQL),
    "title_join": (title_join, TITLE_JOIN_SQL),
    "nested_role_extract": (nested_role_extract, NESTED_ROLE_SQL),
    "pair_explode": (pair_explode, PAIR_EXPLODE_SQL),
}
