"""Queries: graph ranking of people and titles, non-negative factorisation of
the tag matrix, stacking on out-of-fold scores.

Binding: credits = lineitem (order, supplier), titles = all orders; tag matrix =
``embeddings`` shifted by its least entry; base scores = the out-of-fold
encodings of the supplier and part bridges, label = (o_orderstatus = 'F').
The twins run the same fixed number of rounds.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode, factor, graph, stack
from ..session import cut_lineage
from .encoding import PRESTIGE_OOF_SQL
from .tables import movies, part_bridge, r6, supplier_bridge, table

RANK_ROUNDS, NMF_ROUNDS, NMF_K, STACK_ROUNDS = 8, 4, 4, 4


def pagerank_bipartite(spark, sf):
    ranks = graph.credit_ranks(supplier_bridge(spark, sf), "l_orderkey", "l_suppkey",
                               table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey")),
                               rounds=RANK_ROUNDS, tol=0.0)
    n = ranks.count()
    return ranks.select("side", "key", r6(F.col("rank") * n, "score"))  # 1 is the average


def _rank_round(i: int) -> str:
    return f""",
r{i} AS MATERIALIZED (SELECT node, 0.15 / (SELECT count(*) FROM nodes) + 0.85 * (coalesce(got, 0)
        + (SELECT coalesce(sum(r), 0) FROM r{i - 1} ANTI JOIN deg USING (node)) / (SELECT count(*) FROM nodes)) AS r
      FROM nodes LEFT JOIN (SELECT dst AS node, sum(r / n * w) AS got FROM edges JOIN r{i - 1} ON src = r{i - 1}.node
        JOIN deg ON deg.node = src GROUP BY dst) USING (node))"""


PAGERANK_SQL = """
WITH credit AS (SELECT 'e' || l_orderkey AS e, 'p' || l_suppkey AS p, count(*)::DOUBLE AS w FROM lineitem GROUP BY ALL),
edges AS MATERIALIZED (SELECT e AS src, p AS dst, w FROM credit UNION ALL SELECT p, e, w FROM credit),
deg AS MATERIALIZED (SELECT src AS node, sum(w) AS n FROM edges GROUP BY src),
nodes AS MATERIALIZED (SELECT src AS node FROM edges UNION SELECT 'e' || o_orderkey FROM orders),
r0 AS MATERIALIZED (SELECT node, 1.0::DOUBLE / (SELECT count(*) FROM nodes) AS r FROM nodes)""" + "".join(
    _rank_round(i) for i in range(1, RANK_ROUNDS + 1)) + f"""
SELECT CASE WHEN node[1] = 'e' THEN 'entity' ELSE 'person' END AS side, node[2:] AS key,
       round(r * (SELECT count(*) FROM nodes), 6) AS score FROM r{RANK_ROUNDS}"""


def _tags(spark, sf):
    """``embeddings`` shifted by their least entry, so that none is negative."""
    emb = table(spark, sf, "embeddings")
    least = emb.agg(F.min(F.array_min("embedding")).cast("double")).first()[0]  # one number
    return cut_lineage(emb.select("vec_id", F.transform("embedding", lambda x: x.cast("double") - F.lit(least)).alias("v")))


def nmf_components(spark, sf):
    """(component, dim, weight) after the fixed number of rounds."""
    _, h, _ = factor.nmf(_tags(spark, sf), "vec_id", "v", NMF_K, NMF_ROUNDS)
    rows = [(c, j, round(float(h[c, j]), 6)) for c in range(h.shape[0]) for j in range(h.shape[1])]
    return spark.createDataFrame(rows, "component int, dim int, weight double")


def nmf_loss(spark, sf):
    """Loss per round, relative to the sum of squares of the matrix."""
    tags = _tags(spark, sf)
    total = tags.select(F.explode("v").alias("x")).agg(F.sum(F.col("x") * F.col("x"))).first()[0]
    _, _, losses = factor.nmf(tags, "vec_id", "v", NMF_K, NMF_ROUNDS)
    return spark.createDataFrame([(i + 1, round(x / total, 6)) for i, x in enumerate(losses)], "round int, loss double")


def _nmf_round(i: int) -> str:
    p = i - 1
    return f""",
hh{i} AS MATERIALIZED (SELECT a.c AS c, b.c AS e, sum(a.h * b.h) AS g FROM h{p} a JOIN h{p} b USING (j) GROUP BY ALL),
vh{i} AS MATERIALIZED (SELECT id, c, sum(x * h) AS s FROM v JOIN h{p} USING (j) GROUP BY ALL),
wg{i} AS MATERIALIZED (SELECT id, hh{i}.c AS c, sum(w * g) AS s FROM w{p} JOIN hh{i} ON w{p}.c = hh{i}.e GROUP BY ALL),
w{i} AS MATERIALIZED (SELECT id, c, w * vh{i}.s / (wg{i}.s + 1e-12) AS w FROM w{p} JOIN vh{i} USING (id, c) JOIN wg{i} USING (id, c)),
wv{i} AS MATERIALIZED (SELECT c, j, sum(w * x) AS s FROM w{i} JOIN v USING (id) GROUP BY ALL),
ww{i} AS MATERIALIZED (SELECT a.c AS c, b.c AS e, sum(a.w * b.w) AS s FROM w{i} a JOIN w{i} b USING (id) GROUP BY ALL),
h{i} AS MATERIALIZED (SELECT c, j, h * wv{i}.s / (d + 1e-12) AS h FROM h{p} JOIN wv{i} USING (c, j)
  JOIN (SELECT ww{i}.c AS c, j, sum(s * h) AS d FROM ww{i} JOIN h{p} ON ww{i}.e = h{p}.c GROUP BY ALL) USING (c, j)),
l{i} AS (SELECT {i} AS round, sum((x - y) * (x - y)) AS l FROM v JOIN (
  SELECT id, j, sum(w * h) AS y FROM w{i} JOIN h{i} USING (c) GROUP BY ALL) USING (id, j))"""


NMF_CTE = f"""
WITH least AS (SELECT CAST(min(list_min(embedding)) AS DOUBLE) AS m FROM embeddings),
v AS MATERIALIZED (SELECT vec_id AS id, j, x - (SELECT m FROM least) AS x FROM (
  SELECT vec_id, CAST(generate_subscripts(embedding, 1) AS INTEGER) AS j, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)),
w0 AS MATERIALIZED (SELECT vec_id AS id, CAST(c AS INTEGER) AS c, 1.0::DOUBLE AS w FROM embeddings, range(1, {NMF_K + 1}) r(c)),
h0 AS MATERIALIZED (SELECT CAST(c AS INTEGER) AS c, j, 0.5::DOUBLE + (c * c + c * j) % 7 / 7.0::DOUBLE AS h
  FROM range(1, {NMF_K + 1}) r(c), (SELECT DISTINCT j FROM v))""" + "".join(_nmf_round(i) for i in range(1, NMF_ROUNDS + 1))
NMF_COMPONENTS_SQL = NMF_CTE + f"""
SELECT c - 1 AS component, j - 1 AS dim, round(h, 6) AS weight FROM h{NMF_ROUNDS}"""
NMF_LOSS_SQL = NMF_CTE + " SELECT round, round(l / (SELECT sum(x * x) FROM v), 6) AS loss FROM (" + " UNION ALL ".join(
    f"SELECT * FROM l{i}" for i in range(1, NMF_ROUNDS + 1)) + ")"


BASE = ["p_supplier", "p_part"]


def oof_scores(spark, sf):
    """(o_orderkey, fold, y, p_supplier, p_part): base scores, none from a model that saw the row."""
    out = movies(spark, sf).select("o_orderkey", "y", "fold")
    for bridge, person, name in ((supplier_bridge, "l_suppkey", BASE[0]), (part_bridge, "l_partkey", BASE[1])):
        out = encode.out_of_fold_encode(out, bridge(spark, sf).withColumnRenamed("l_orderkey", "o_orderkey"),
                                        "o_orderkey", person, "y", "fold", name)
    return cut_lineage(out)


def stack_coefficients(spark, sf):
    """Coefficients of the second level per left-out fold (-1: none left out)."""
    beta = stack.fit_stack(oof_scores(spark, sf), BASE, rounds=STACK_ROUNDS, tol=0.0)
    rows = [(-1 if f is None else int(f), *[round(float(x), 4) for x in b]) for f, b in beta.items()]
    return spark.createDataFrame(rows, "left_out int, intercept double, b_supplier double, b_part double")


def stack_scores(spark, sf):
    """Second-level probability of every order, by the model without its fold."""
    scores = oof_scores(spark, sf)
    beta = stack.fit_stack(scores, BASE, rounds=STACK_ROUNDS, tol=0.0)
    return stack.stacked(scores, BASE, beta).select("o_orderkey", F.round("p", 4).alias("p"))


def _stack_round(i: int) -> str:
    h = [(0, 0), (0, 1), (0, 2), (1, 1), (1, 2), (2, 2)]
    x = ["1.0", "x1", "x2"]
    sums = ", ".join([f"sum(w * {x[a]} * {x[b]}) + {stack.RIDGE if a == b else 0.0} AS h{a}{b}" for a, b in h]
                     + [f"sum(r * {x[a]}) - {stack.RIDGE} * any_value(b{a}) AS g{a}" for a in range(3)]
                     + [f"any_value(b{a}) AS b{a}" for a in range(3)])
    m = lambda a, b: f"h{min(a, b)}{max(a, b)}"

    def det(cols):
        return (f"({cols(0, 0)} * ({cols(1, 1)} * {cols(2, 2)} - {cols(1, 2)} * {cols(2, 1)})"
                f" - {cols(0, 1)} * ({cols(1, 0)} * {cols(2, 2)} - {cols(1, 2)} * {cols(2, 0)})"
                f" + {cols(0, 2)} * ({cols(1, 0)} * {cols(2, 1)} - {cols(1, 1)} * {cols(2, 0)}))")
    new = ", ".join(f"b{c} + {det(lambda a, b, c=c: f'g{a}' if b == c else m(a, b))} / {det(m)} AS b{c}" for c in range(3))
    return f""",
s{i} AS MATERIALIZED (SELECT k, {sums} FROM (SELECT b.*, x1, x2, p * (1 - p) AS w, y - p AS r FROM (
    SELECT b.*, x1, x2, y, 1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))) AS p FROM b{i - 1} b JOIN x ON b.k <> x.f) b) b GROUP BY k),
b{i} AS MATERIALIZED (SELECT k, {new} FROM s{i})"""


_PART_OOF_SQL = PRESTIGE_OOF_SQL.replace("l_suppkey", "l_partkey").replace("director_prestige", "x2").replace(
    ", 6) AS x2", ", 18) AS x2")
_SUPPLIER_OOF_SQL = PRESTIGE_OOF_SQL.replace("director_prestige", "x1").replace(", 6) AS x1", ", 18) AS x1")
STACK_CTE = f"""
WITH x AS MATERIALIZED (SELECT a.o_orderkey, a.fold AS f, x1, x2, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y
  FROM ({_SUPPLIER_OOF_SQL}) a JOIN ({_PART_OOF_SQL}) b USING (o_orderkey) JOIN orders USING (o_orderkey)),
b0 AS (SELECT k, 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2 FROM (SELECT DISTINCT f AS k FROM x UNION ALL SELECT -1))""" \
    + "".join(_stack_round(i) for i in range(1, STACK_ROUNDS + 1))
STACK_COEFFICIENTS_SQL = STACK_CTE + f"""
SELECT CAST(k AS INTEGER) AS left_out, round(b0, 4) AS intercept, round(b1, 4) AS b_supplier, round(b2, 4) AS b_part FROM b{STACK_ROUNDS}"""
STACK_SCORES_SQL = STACK_CTE + f"""
SELECT o_orderkey, round(1 / (1 + exp(-(b0 + b1 * x1 + b2 * x2))), 4) AS p FROM x JOIN b{STACK_ROUNDS} ON k = f"""


QUERIES = {
    "pagerank_bipartite": (pagerank_bipartite, PAGERANK_SQL),
    "nmf_components": (nmf_components, NMF_COMPONENTS_SQL),
    "nmf_loss": (nmf_loss, NMF_LOSS_SQL),
    "stack_coefficients": (stack_coefficients, STACK_COEFFICIENTS_SQL),
    "stack_scores": (stack_scores, STACK_SCORES_SQL),
}
