"""Queries: ranks, Mann-Whitney, BH, binned and permutation MI, gates,
partial Spearman, Spearman matrix, redundancy prune, point-biserial top-N,
covariance, PCA and the full screening report.

Binding: documents JOIN labels, label = quality, features computed from the
whole text (deliberately redundant: log_chars is monotone in n_chars).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.special import digamma_sql, normal_sf_sql
from ..operators import stats
from ..session import cut_lineage
from .tables import r6, table

FEATURES = ["n_chars", "n_words", "uniq_ratio", "mean_word_len", "digit_share",
            "punct_share", "log_chars"]
PARTIAL_TESTS = [("n_words", ["n_chars"]), ("mean_word_len", ["n_words", "n_chars"]),
                 ("uniq_ratio", ["n_words"])]
N_PERMS = 100
BINS = 10
K_NEIGHBORS = 5
MW_ALPHA, MI_ALPHA, CORR_THRESHOLD, PARTIAL_ALPHA = 0.05, 0.1, 0.85, 0.05


def doc_features(spark, sf):
    d = table(spark, sf, "documents")
    lab = table(spark, sf, "labels").select("doc_id", "quality")
    words = F.split(F.col("text"), r"\s+")
    nw = F.size(words)
    f = d.join(lab, "doc_id").select(
        "doc_id", "quality",
        F.col("n_chars").cast("double").alias("n_chars"),
        nw.cast("double").alias("n_words"),
        (F.size(F.array_distinct(words)) / nw).alias("uniq_ratio"),
        (F.aggregate(words, F.lit(0).cast("long"), lambda acc, w: acc + F.length(w)) / nw)
        .alias("mean_word_len"),
        (F.length(F.regexp_replace("text", "[^0-9]", "")) / F.length("text")).alias("digit_share"),
        (F.length(F.regexp_replace("text", "[^.,;:!?]", "")) / F.length("text")).alias("punct_share"),
        F.log1p("n_chars").alias("log_chars"))
    return f


def long_form(spark, sf):
    """The long (id, y, feature, x) table, written once: every screening plan
    reads it from several branches, and the features scan whole texts."""
    return cut_lineage(stats.to_long(doc_features(spark, sf), "doc_id", "quality", FEATURES))


FEAT_CTE = r"""
feat AS (
  SELECT d.doc_id AS id, l.quality AS y, CAST(d.n_chars AS DOUBLE) AS n_chars,
    CAST(len(regexp_split_to_array(d.text, '\s+')) AS DOUBLE) AS n_words,
    len(list_distinct(regexp_split_to_array(d.text, '\s+'))) / len(regexp_split_to_array(d.text, '\s+')) AS uniq_ratio,
    list_sum(list_transform(regexp_split_to_array(d.text, '\s+'), lambda w: length(w))) / len(regexp_split_to_array(d.text, '\s+')) AS mean_word_len,
    length(regexp_replace(d.text, '[^0-9]', '', 'g')) / length(d.text) AS digit_share,
    length(regexp_replace(d.text, '[^.,;:!?]', '', 'g')) / length(d.text) AS punct_share,
    ln(d.n_chars + 1) AS log_chars
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id),
long AS (""" + "\n  UNION ALL ".join(
    f"SELECT id, y, '{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM feat" for f in FEATURES) + """),
vc AS (SELECT feature, x, count(*) AS n, sum(1 - y) AS n0 FROM long GROUP BY feature, x),
rv AS (SELECT feature, x, n, n0,
         coalesce(sum(n) OVER (PARTITION BY feature ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           + (n + 1) / 2.0 AS rank
       FROM vc)"""

MW_BODY = """,
mwp AS (SELECT feature, CAST(sum(n0) AS BIGINT) AS n0, CAST(sum(n - n0) AS BIGINT) AS n1,
          sum(rank * n0) AS r0, sum(CAST(n AS DOUBLE) * n * n - n) AS ties FROM rv GROUP BY feature),
mwu AS (SELECT feature, n0, n1, r0 - n0 * (n0 + 1) / 2.0 AS u, ties FROM mwp),
mw AS (SELECT feature, n0, n1, u, 1 - 2 * u / (n0 * n1) AS effect,
         (abs(u - n0 * n1 / 2.0) - 0.5) / sqrt(n0 * n1 / 12.0 * ((n0 + n1 + 1) - ties / ((n0 + n1) * (n0 + n1 - 1.0)))) AS z
       FROM mwu),
mwz AS (SELECT *, least(1.0, 2 * """ + normal_sf_sql("z") + """) AS p_value FROM mw)"""
MW_CTE = FEAT_CTE + MW_BODY

BINS_CTE = f""",
vb AS (SELECT feature, x, CAST(floor((rank - 0.5) * {BINS} / sum(n) OVER (PARTITION BY feature)) AS INTEGER) AS bin FROM rv),
rb AS (SELECT long.id, long.y, long.feature, vb.bin FROM long JOIN vb ON vb.feature = long.feature AND vb.x = long.x)"""


def _mi_sql(src: str, keys: str) -> str:
    return f"""SELECT {keys}, greatest(0.0, sum(c / nn * ln(c * nn / (cb * cy)))) AS mi FROM (
      SELECT *, sum(c) OVER (PARTITION BY {keys}, bin) AS cb, sum(c) OVER (PARTITION BY {keys}, y) AS cy,
             sum(c) OVER (PARTITION BY {keys}) AS nn FROM {src}) GROUP BY {keys}"""


PERM_BODY = BINS_CTE + f""",
rmi AS ({_mi_sql("(SELECT feature, bin, y, count(*) AS c FROM rb GROUP BY feature, bin, y)", "feature")}),
rws AS (SELECT DISTINCT id, y FROM long),
rep AS (SELECT p.range AS perm, rws.id FROM rws CROSS JOIN range({N_PERMS}) p),
py AS (SELECT perm, id, CASE WHEN row_number() OVER (
         PARTITION BY perm ORDER BY md5(CAST(perm AS VARCHAR) || ':' || CAST(id AS VARCHAR)) || CAST(id AS VARCHAR))
         <= (SELECT sum(y) FROM rws) THEN 1 ELSE 0 END AS y FROM rep),
pc AS (SELECT py.perm, rb.feature, rb.bin, py.y, count(*) AS c FROM rb JOIN py ON py.id = rb.id
       GROUP BY py.perm, rb.feature, rb.bin, py.y),
nmi AS ({_mi_sql("pc", "perm, feature")}),
perm AS (SELECT nmi.feature, any_value(round(rmi.mi, 12)) AS mi,
           quantile_cont(round(nmi.mi, 12), 0.95) AS null_q,
           (count(*) FILTER (WHERE round(nmi.mi, 12) >= round(rmi.mi, 12)) + 1) / {N_PERMS + 1.0} AS p_value
         FROM nmi JOIN rmi ON rmi.feature = nmi.feature GROUP BY nmi.feature)"""
PERM_CTE = FEAT_CTE + PERM_BODY


def _bh_sql(src: str, alpha: float) -> str:
    return f"""SELECT *, least(1.0, min(p_value * cnt / rn) OVER (ORDER BY p_value, feature
                 ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS p_adj FROM (
             SELECT *, count(*) OVER () AS cnt, row_number() OVER (ORDER BY p_value, feature) AS rn FROM {src})"""


# --------------------------------------------------------------------- queries
def avg_rank(spark, sf):
    rr = stats.row_ranks(long_form(spark, sf))
    return rr.select("id", "feature", r6("rank"))


AVG_RANK_SQL = "WITH " + FEAT_CTE + """
SELECT long.id, long.feature, round(rv.rank, 6) AS rank FROM long JOIN rv ON rv.feature = long.feature AND rv.x = long.x"""


def mann_whitney(spark, sf):
    mw = stats.mann_whitney(long_form(spark, sf))
    return mw.select("feature", "n0", "n1", r6("u"), r6("effect"), r6("z"), r6("p_value"))


MANN_WHITNEY_SQL = "WITH " + MW_CTE + """
SELECT feature, n0, n1, round(u, 6) AS u, round(effect, 6) AS effect, round(z, 6) AS z,
       round(p_value, 6) AS p_value FROM mwz"""


def small_groups(spark, sf):
    """Suppliers' balances by nation as features, odd keys as label: small classes without ties."""
    s, n = table(spark, sf, "supplier"), table(spark, sf, "nation")
    return s.join(F.broadcast(n.select("n_nationkey", "n_name")), s["s_nationkey"] == F.col("n_nationkey")).select(  # 25 rows
        F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 2).cast("int").alias("y"), F.col("n_name").alias("feature"),
        F.col("s_acctbal").cast("double").alias("x"))


def mann_whitney_exact(spark, sf):
    mw = stats.mann_whitney(small_groups(spark, sf))
    return mw.select("feature", "n0", "n1", r6("u"), r6("p_value"))


MOST_ROWS = 48  # of a nation with an exact test, in the twin


def _ways(n: int) -> str:
    """Ways to choose m of the ranks 1..n with sum s, from those of n - 1."""
    return f""",
ways{n} AS MATERIALIZED (SELECT m, s, sum(c)::DOUBLE AS c FROM (SELECT m, s, c FROM ways{n - 1}
  UNION ALL SELECT m + 1, s + {n}, c FROM ways{n - 1} WHERE m < 8) GROUP BY m, s)"""


MANN_WHITNEY_EXACT_SQL = """
WITH long AS (SELECT s_suppkey AS id, s_suppkey % 2 AS y, n_name AS feature, CAST(s_acctbal AS DOUBLE) AS x
              FROM supplier JOIN nation ON s_nationkey = n_nationkey),
""" + FEAT_CTE[FEAT_CTE.index("vc AS (SELECT"):] + MW_BODY + """,
ways0 AS (SELECT 0 AS m, 0 AS s, 1.0::DOUBLE AS c)""" + "".join(_ways(n) for n in range(1, MOST_ROWS + 1)) + """,
ways AS (""" + " UNION ALL ".join(f"SELECT {n} AS n, * FROM ways{n}" for n in range(1, MOST_ROWS + 1)) + """),
small AS (SELECT m.feature, n0 + n1 AS n, least(n0, n1) AS m, greatest(u, n0 * n1 - u) AS u
          FROM mwz m JOIN (SELECT feature, ties FROM mwp) USING (feature) WHERE least(m.n0, m.n1) BETWEEN 1 AND 8 AND ties = 0),
exact AS (SELECT feature, least(1.0, 2 * sum(CASE WHEN s - w.m * (w.m + 1) / 2 >= u THEN c ELSE 0 END) / sum(c)) AS p
          FROM small JOIN ways w ON w.n = small.n AND w.m = small.m GROUP BY feature)
SELECT feature, n0, n1, round(u, 6) AS u, round(CASE WHEN n0 * n1 = 0 THEN 1.0 ELSE coalesce(p, p_value, 1.0) END, 6) AS p_value
FROM mwz LEFT JOIN exact USING (feature)"""


def mi_binned(spark, sf):
    return stats.mi_binned(long_form(spark, sf), BINS).select("feature", r6("mi"))


MI_BINNED_SQL = "WITH " + FEAT_CTE + BINS_CTE + f"""
SELECT feature, round(mi, 6) AS mi FROM ({_mi_sql("(SELECT feature, bin, y, count(*) AS c FROM rb GROUP BY feature, bin, y)", "feature")})"""


def mi_permutation(spark, sf):
    mp = stats.mi_permutation(long_form(spark, sf), N_PERMS, BINS)
    return mp.select("feature", r6("mi"), r6("null_q"), r6("p_value"))


MI_PERMUTATION_SQL = "WITH " + PERM_CTE + """
SELECT feature, round(mi, 6) AS mi, round(null_q, 6) AS null_q, round(p_value, 6) AS p_value FROM perm"""


def bh_adjust(spark, sf):
    mp = stats.mi_permutation(long_form(spark, sf), N_PERMS, BINS)
    out = stats.bh_adjust(mp, "p_value", "p_adj", alpha=MI_ALPHA)
    return out.select("feature", r6("p_value"), r6("p_adj"), "reject")


BH_ADJUST_SQL = "WITH " + PERM_CTE + f"""
SELECT feature, round(p_value, 6) AS p_value, round(p_adj, 6) AS p_adj, p_adj < {MI_ALPHA} AS reject
FROM ({_bh_sql("perm", MI_ALPHA)})"""


def screen_gates(spark, sf, estimator="binned"):
    lf = long_form(spark, sf)
    mw = stats.bh_adjust(stats.mann_whitney(lf), "p_value", "mw_p_adj", alpha=MW_ALPHA,
                         reject_col="mw_reject")
    mp = stats.bh_adjust(stats.mi_permutation(lf, N_PERMS, BINS, estimator=estimator,
                                              k=K_NEIGHBORS),
                         "p_value", "mi_p_adj", alpha=MI_ALPHA, reject_col="mi_reject")
    return mw.select("feature", "effect", "mw_p_adj", "mw_reject").join(
        mp.select("feature", "mi", "null_q", "mi_p_adj", "mi_reject"), "feature")


def screen_candidates(spark, sf):
    g = screen_gates(spark, sf)
    return g.select("feature", r6("mw_p_adj"), r6("mi_p_adj"),
                    (F.col("mw_reject") & F.col("mi_reject")).cast("int").alias("passed"))


SCREEN_CANDIDATES_SQL = "WITH " + FEAT_CTE + MW_BODY + PERM_BODY + f""",
mwa AS ({_bh_sql("mwz", MW_ALPHA)}),
mia AS ({_bh_sql("perm", MI_ALPHA)})
SELECT mwa.feature, round(mwa.p_adj, 6) AS mw_p_adj, round(mia.p_adj, 6) AS mi_p_adj,
       CASE WHEN mwa.p_adj < {MW_ALPHA} AND mia.p_adj < {MI_ALPHA} THEN 1 ELSE 0 END AS passed
FROM mwa JOIN mia ON mia.feature = mwa.feature"""


def rank_table(spark, sf):
    return stats.rank_wide(long_form(spark, sf), FEATURES)


def partial_spearman(spark, sf):
    ps = stats.partial_spearman(rank_table(spark, sf), PARTIAL_TESTS)
    return ps.select("feature", "controls", "n", r6("rho"), r6("t_stat"))


RANK_WIDE_CTE = FEAT_CTE + """,
rr AS (SELECT long.id, long.y, long.feature, rv.rank FROM long JOIN rv ON rv.feature = long.feature AND rv.x = long.x),
yv AS (SELECT y, count(*) AS n FROM (SELECT DISTINCT id, y FROM long) GROUP BY y),
yr AS (SELECT y, coalesce(sum(n) OVER (ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2.0 AS lrank FROM yv),
wide AS (SELECT rr.id, any_value(yr.lrank) AS __label, """ + ", ".join(
    f"max(CASE WHEN rr.feature = '{f}' THEN rr.rank END) AS {f}" for f in FEATURES) + """
  FROM rr JOIN yr ON yr.y = rr.y GROUP BY rr.id)"""


def _partial_sql_one(i: int, feat: str, ctrls: list[str]) -> str:
    def resid(t):
        if len(ctrls) == 1:
            c = ctrls[0]
            return (f"{t} - ((SELECT avg({t}) - covar_pop({t}, {c}) / var_pop({c}) * avg({c}) FROM wide)"
                    f" + (SELECT covar_pop({t}, {c}) / var_pop({c}) FROM wide) * {c})")
        c1, c2 = ctrls
        det = f"(var_pop({c1}) * var_pop({c2}) - covar_pop({c1}, {c2}) * covar_pop({c1}, {c2}))"
        b1 = f"((covar_pop({t}, {c1}) * var_pop({c2}) - covar_pop({t}, {c2}) * covar_pop({c1}, {c2})) / {det})"
        b2 = f"((covar_pop({t}, {c2}) * var_pop({c1}) - covar_pop({t}, {c1}) * covar_pop({c1}, {c2})) / {det})"
        a = f"(avg({t}) - {b1} * avg({c1}) - {b2} * avg({c2}))"
        return (f"{t} - ((SELECT {a} FROM wide) + (SELECT {b1} FROM wide) * {c1}"
                f" + (SELECT {b2} FROM wide) * {c2})")
    return f"""
pr{i} AS (SELECT id, round({resid(feat)}, 9) AS rx, round({resid('__label')}, 9) AS ry FROM wide),
prl{i} AS (SELECT id, 'rx' AS f, rx AS v FROM pr{i} UNION ALL SELECT id, 'ry', ry FROM pr{i}),
prv{i} AS (SELECT f, v, coalesce(sum(n) OVER (PARTITION BY f ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + (n + 1) / 2.0 AS rk
           FROM (SELECT f, v, count(*) AS n FROM prl{i} GROUP BY f, v)),
prw{i} AS (SELECT prl{i}.id, max(CASE WHEN prl{i}.f = 'rx' THEN rk END) AS rx, max(CASE WHEN prl{i}.f = 'ry' THEN rk END) AS ry
           FROM prl{i} JOIN prv{i} ON prv{i}.f = prl{i}.f AND prv{i}.v = prl{i}.v GROUP BY prl{i}.id),
ps{i} AS (SELECT '{feat}' AS feature, '{",".join(ctrls)}' AS controls, count(*) AS n, corr(rx, ry) AS rho FROM prw{i})"""


PARTIAL_SPEARMAN_SQL = "WITH " + RANK_WIDE_CTE + "," + ",".join(
    _partial_sql_one(i, f, c) for i, (f, c) in enumerate(PARTIAL_TESTS)) + """
SELECT feature, controls, n, round(rho, 6) AS rho, round(rho * sqrt((n - 2) / (1 - rho * rho)), 6) AS t_stat
FROM (""" + " UNION ALL ".join(f"SELECT * FROM ps{i}" for i in range(len(PARTIAL_TESTS))) + ")"


def spearman_matrix(spark, sf):
    sp = stats.spearman_pairs(rank_table(spark, sf), FEATURES)
    return sp.select("feature_a", "feature_b", r6("rho"))


SPEARMAN_MATRIX_SQL = "WITH " + RANK_WIDE_CTE + "\n" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS rho FROM wide"
    for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:])


def pointbiserial_top(spark, sf):
    return stats.point_biserial_top(long_form(spark, sf), 3).select("feature", r6("abs_r"))


POINTBISERIAL_SQL = "WITH " + FEAT_CTE + """
SELECT feature, round(abs(corr(x, y)), 6) AS abs_r FROM long GROUP BY feature
HAVING stddev_pop(x) > 0 AND corr(x, y) IS NOT NULL
ORDER BY abs(corr(x, y)) DESC, feature LIMIT 3"""


def redundancy_prune(spark, sf):
    ranks = rank_table(spark, sf)
    mi = {r["feature"]: round(r["mi"], 6) for r in stats.mi_knn(long_form(spark, sf), K_NEIGHBORS).collect()}
    kept = set(stats.redundancy_prune(FEATURES, stats.conflicts(ranks, FEATURES, CORR_THRESHOLD), mi))
    rows = [(f, int(f in kept), float(mi.get(f, 0.0))) for f in FEATURES]
    return spark.createDataFrame(rows, "feature string, kept int, mi double")


def screen_report(spark, sf):
    """The reference's four stages with its estimators (Mann-Whitney + BH,
    kNN-MI permutation test + BH, partial Spearman, kNN-MI-ranked redundancy),
    selecting on all labelled rows as the reference does; see
    ``stats.screen_in_folds`` for selection inside folds."""
    return stats.screen(long_form(spark, sf), FEATURES, PARTIAL_TESTS, n_perms=N_PERMS,
                        estimator="knn", k=K_NEIGHBORS, bins=BINS, mw_alpha=MW_ALPHA,
                        mi_alpha=MI_ALPHA, partial_alpha=PARTIAL_ALPHA,
                        corr_threshold=CORR_THRESHOLD)


def cov_matrix(spark, sf):
    emb = table(spark, sf, "embeddings")
    return stats.covariance_matrix(emb, "embedding").select("i", "j", r6("cov"))


COV_MATRIX_SQL = """
WITH l AS (SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS d,
                  CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
SELECT a.d AS i, b.d AS j, round(covar_samp(a.v, b.v), 6) AS cov
FROM l a JOIN l b ON a.vec_id = b.vec_id AND a.d <= b.d GROUP BY a.d, b.d"""


def pca_components(spark, sf):
    emb = table(spark, sf, "embeddings")
    scores, _model = stats.pca_scores(emb, "vec_id", "embedding", k=30)
    return scores


def mi_knn(spark, sf):
    return stats.mi_knn(long_form(spark, sf), k=K_NEIGHBORS).select("feature", r6("mi"))


def _knn_radius_sql(k: int) -> str:
    def at(d):
        return "v" if d == 0 else (f"m{-d}" if d < 0 else f"p{d}")
    cases = []
    for kk in range(k, 0, -1):
        terms = [f"CASE WHEN {at(-j)} IS NOT NULL AND {at(kk - j)} IS NOT NULL "
                 f"THEN greatest(v - {at(-j)}, {at(kk - j)} - v) END" for j in range(kk + 1)]
        cases.append(f"WHEN {kk} THEN least({', '.join(terms)})")
    return "CASE kc " + " ".join(cases) + " END"


KNN_SCALE_CTE = """,
ksc AS (SELECT feature, stddev_pop(x) AS sd, avg(abs(x)) AS mabs FROM long GROUP BY feature)"""


def _knn_sql(src: str, keys: list[str], p: str) -> str:
    """CTEs computing kNN MI per ``keys`` from ``src`` (keys..., id, y, x);
    the last CTE ``{p}mi`` holds (keys..., mi).  Needs ``ksc``."""
    K = ", ".join(keys)
    on = lambda a, b: " AND ".join(f"{a}.{c} = {b}.{c}" for c in keys)
    dg = digamma_sql
    return f""",
{p}pt0 AS (SELECT {", ".join("s." + c for c in keys)}, s.id, s.y,
          s.x / CASE WHEN ksc.sd > 0 THEN ksc.sd ELSE 1.0 END
          + 1e-10 * greatest(1.0, ksc.mabs / CASE WHEN ksc.sd > 0 THEN ksc.sd ELSE 1.0 END) *
            (CAST('0x' || substr(md5(s.feature || ':' || CAST(s.id AS VARCHAR)), 1, 13) AS BIGINT)::DOUBLE / {float(1 << 52)} - 0.5) AS v
        FROM {src} s JOIN ksc ON ksc.feature = s.feature),
{p}cc AS (SELECT {K}, y, count(*) AS nc FROM {p}pt0 GROUP BY {K}, y),
{p}pts AS (SELECT a.*, c.nc, least({K_NEIGHBORS}, c.nc - 1) AS kc FROM {p}pt0 a
        JOIN {p}cc c ON {on("c", "a")} AND c.y = a.y WHERE c.nc > 1),
{p}nb AS (SELECT *, """ + ", ".join(
        [f"lag(v, {j}) OVER w AS m{j}" for j in range(1, K_NEIGHBORS + 1)]
        + [f"lead(v, {j}) OVER w AS p{j}" for j in range(1, K_NEIGHBORS + 1)]) + f"""
       FROM {p}pts WINDOW w AS (PARTITION BY {K}, y ORDER BY v, id)),
{p}rd AS (SELECT {K}, id, v, kc, nc, ({_knn_radius_sql(K_NEIGHBORS)}) * (1.0 - 1e-12) AS rad FROM {p}nb),
{p}mm AS (SELECT {", ".join("a." + c for c in keys)}, a.id, count(*) AS m FROM {p}rd a JOIN {p}pts b
       ON {on("b", "a")} AND ((b.v > a.v - a.rad AND b.v < a.v + a.rad) OR (a.rad = 0 AND b.v = a.v)) GROUP BY {", ".join("a." + c for c in keys)}, a.id),
{p}mi AS (SELECT {", ".join("r." + c for c in keys)}, greatest(0.0, {dg("CAST(count(*) AS DOUBLE)")} + avg({dg("CAST(r.kc AS DOUBLE)")})
       - avg({dg("CAST(r.nc AS DOUBLE)")}) - avg({dg("CAST(greatest(mm.m, 1) AS DOUBLE)")})) AS mi
       FROM {p}rd r JOIN {p}mm mm ON {on("mm", "r")} AND mm.id = r.id GROUP BY {", ".join("r." + c for c in keys)})"""


MI_KNN_SQL = "WITH " + FEAT_CTE + KNN_SCALE_CTE + _knn_sql("long", ["feature"], "k") + """
SELECT feature, round(mi, 6) AS mi FROM kmi"""


def mi_permutation_knn(spark, sf):
    mp = stats.mi_permutation(long_form(spark, sf), N_PERMS, estimator="knn", k=K_NEIGHBORS)
    return mp.select("feature", r6("mi"), r6("null_q"), r6("p_value"))


PERMY_BODY = f""",
rws AS (SELECT DISTINCT id, y FROM long),
rep AS (SELECT p.range AS perm, rws.id FROM rws CROSS JOIN range({N_PERMS}) p),
py AS (SELECT perm, id, CASE WHEN row_number() OVER (
         PARTITION BY perm ORDER BY md5(CAST(perm AS VARCHAR) || ':' || CAST(id AS VARCHAR)) || CAST(id AS VARCHAR))
         <= (SELECT sum(y) FROM rws) THEN 1 ELSE 0 END AS y FROM rep),
plong AS (SELECT py.perm, long.id, py.y, long.feature, long.x FROM long JOIN py ON py.id = long.id)"""

MI_PERMUTATION_KNN_SQL = ("WITH " + FEAT_CTE + KNN_SCALE_CTE + PERMY_BODY
                          + _knn_sql("long", ["feature"], "k") + _knn_sql("plong", ["perm", "feature"], "q")
                          + f"""
SELECT q.feature, round(any_value(round(k.mi, 12)), 6) AS mi,
       round(quantile_cont(round(q.mi, 12), 0.95), 6) AS null_q,
       round((count(*) FILTER (WHERE round(q.mi, 12) >= round(k.mi, 12)) + 1) / {N_PERMS + 1.0}, 6) AS p_value
FROM qmi q JOIN kmi k ON k.feature = q.feature GROUP BY q.feature""")

# the walk over conflicting pairs, in order; gone is the list of dropped features
_PLACE = ", ".join(f"({i}, '{f}')" for i, f in enumerate(FEATURES))
REDUNDANCY_PRUNE_SQL = "WITH RECURSIVE " + FEAT_CTE + KNN_SCALE_CTE + _knn_sql("long", ["feature"], "k") + RANK_WIDE_CTE[len(FEAT_CTE):] + """,
place(i, feature) AS (VALUES """ + _PLACE + """),
m AS (SELECT i, place.feature, coalesce(round(kmi.mi, 6), 0) AS mi FROM place LEFT JOIN kmi USING (feature)),
rho(a, b, rho) AS (""" + " UNION ALL ".join(
    f"SELECT {i}, {j}, corr({a}, {b}) FROM wide" for i, a in enumerate(FEATURES)
    for j, b in enumerate(FEATURES) if j > i) + f"""),
edge AS (SELECT row_number() OVER (ORDER BY rho.a, rho.b) AS n, rho.a, rho.b, x.mi AS ma, y.mi AS mb
         FROM rho JOIN m x ON x.i = rho.a JOIN m y ON y.i = rho.b WHERE abs(rho.rho) > {CORR_THRESHOLD}),
walk(n, gone) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS INTEGER[])
  UNION ALL
  SELECT edge.n, CASE WHEN list_contains(gone, edge.a) OR list_contains(gone, edge.b) THEN gone
                      WHEN ma < mb THEN list_append(gone, edge.a) ELSE list_append(gone, edge.b) END
  FROM walk JOIN edge ON edge.n = walk.n + 1)
SELECT feature, CASE WHEN list_contains((SELECT gone FROM walk ORDER BY n DESC LIMIT 1), i) THEN 0 ELSE 1 END AS kept, mi
FROM m"""


QUERIES = {
    "mi_knn": (mi_knn, MI_KNN_SQL),
    "mi_permutation_knn": (mi_permutation_knn, MI_PERMUTATION_KNN_SQL),
    "avg_rank": (avg_rank, AVG_RANK_SQL),
    "mann_whitney": (mann_whitney, MANN_WHITNEY_SQL),
    "mann_whitney_exact": (mann_whitney_exact, MANN_WHITNEY_EXACT_SQL),
    "mi_binned": (mi_binned, MI_BINNED_SQL),
    "mi_permutation": (mi_permutation, MI_PERMUTATION_SQL),
    "bh_adjust": (bh_adjust, BH_ADJUST_SQL),
    "screen_candidates": (screen_candidates, SCREEN_CANDIDATES_SQL),
    "partial_spearman": (partial_spearman, PARTIAL_SPEARMAN_SQL),
    "spearman_matrix": (spearman_matrix, SPEARMAN_MATRIX_SQL),
    "pointbiserial_top": (pointbiserial_top, POINTBISERIAL_SQL),
    "redundancy_prune": (redundancy_prune, REDUNDANCY_PRUNE_SQL),
    "screen_report": (screen_report, None),
    "cov_matrix": (cov_matrix, COV_MATRIX_SQL),
    "pca_components": (pca_components, None),
}
