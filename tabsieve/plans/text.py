"""Queries: token counts, TF-IDF top terms, IDF applied to all splits, wide
top-term columns, hashed TF-IDF, encoding-damage report.

Binding: documents.text (whole texts); train split = doc_id % 10 < 8.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import text as T
from ..session import cut_lineage, spread
from .tables import r6, table

# Fixed short stop list for the benchmark binding (four languages).
STOP_WORDS = ["the", "a", "an", "and", "of", "to", "in", "is", "le", "la", "les", "de",
              "et", "der", "die", "das", "und", "el", "los", "y"]
TOP_N = 50

_stop_sql = ", ".join(f"'{w}'" for w in STOP_WORDS)
TOK_CTE = rf"""
tok AS (SELECT doc_id AS doc, term FROM (
          SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\s+')) AS term FROM documents)
        WHERE term <> '' AND term NOT IN ({_stop_sql})),
tf AS (SELECT doc, term, count(*) AS tf FROM tok GROUP BY doc, term),
trn AS (SELECT * FROM tf WHERE doc % 10 < 8),
ntr AS (SELECT count(*) AS n FROM documents WHERE doc_id % 10 < 8),
dfs AS (SELECT term, sum(tf) AS total, count(*) AS df FROM trn GROUP BY term),
top AS (SELECT term, ln(((SELECT n FROM ntr) + 1.0) / (df + 1.0)) AS idf,
               total * ln(((SELECT n FROM ntr) + 1.0) / (df + 1.0)) AS mass,
               row_number() OVER (ORDER BY total * ln(((SELECT n FROM ntr) + 1.0) / (df + 1.0)) DESC, term) - 1 AS idx
        FROM dfs ORDER BY mass DESC, term LIMIT {TOP_N}),
wts AS (SELECT tf.doc, tf.term, tf.tf * ln(((SELECT n FROM ntr) + 1.0) / (coalesce(dfs.df, 0) + 1.0)) AS weight
        FROM tf LEFT JOIN dfs ON dfs.term = tf.term)"""


def _docs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


def _tf(spark, sf):
    d = _docs(spark, sf)
    # texts move once, by document; their (doc, term) pairs are then counted in place
    tf_all = T.term_freqs(T.tokens(spread(d, "doc_id"), "doc_id", "text", STOP_WORDS))
    tf_train = tf_all.where(F.col("doc") % 10 < 8)
    n_train = d.where(F.col("doc_id") % 10 < 8).select(F.count(F.lit(1))).scalar()
    return d, tf_all, tf_train, n_train


def token_counts(spark, sf):
    _, tf_all, _, _ = _tf(spark, sf)
    return T.term_stats(tf_all)


TOKEN_COUNTS_SQL = "WITH " + TOK_CTE + """
SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df FROM tf GROUP BY term"""


def tfidf_top_terms(spark, sf):
    _, tf_all, _, n_train = _tf(spark, sf)
    top = T.top_terms(tf_all, n_train, TOP_N, train=F.col("doc") % 10 < 8)
    return top.select("term", r6("idf"), r6("mass"), F.col("idx").cast("int").alias("idx"))


TFIDF_TOP_SQL = "WITH " + TOK_CTE + """
SELECT term, round(idf, 6) AS idf, round(mass, 6) AS mass, CAST(idx AS INTEGER) AS idx FROM top"""


def idf_train_apply(spark, sf):
    d, tf_all, _, n_train = _tf(spark, sf)
    tf_all = cut_lineage(tf_all)  # read for the training IDF and for the weights
    tf_train = tf_all.where(F.col("doc") % 10 < 8)
    w = T.tfidf_weights(tf_all, tf_train, n_train)
    per_doc = w.groupBy("doc").agg(F.count(F.lit(1)).alias("n_terms"),
                                   F.sum("weight").alias("tfidf_l1"),
                                   F.max("weight").alias("tfidf_max"))
    # documents without a kept token stay, with zeros
    full = d.select("doc_id").join(per_doc, F.col("doc_id") == F.col("doc"), "left") \
        .fillna(0, ["n_terms", "tfidf_l1", "tfidf_max"])
    return full.select("doc_id", (F.col("doc_id") % 10 < 8).alias("is_train"),
                       "n_terms", r6("tfidf_l1"), r6("tfidf_max"))


IDF_APPLY_SQL = "WITH " + TOK_CTE + """
SELECT d.doc_id, d.doc_id % 10 < 8 AS is_train, count(wts.doc) AS n_terms,
       round(coalesce(sum(weight), 0), 6) AS tfidf_l1, round(coalesce(max(weight), 0), 6) AS tfidf_max
FROM documents d LEFT JOIN wts ON wts.doc = d.doc_id GROUP BY d.doc_id"""


def tfidf_wide(spark, sf):
    d, tf_all, _, n_train = _tf(spark, sf)
    tf_all = cut_lineage(tf_all)  # read for the top terms and for their columns
    top = T.top_terms(tf_all, n_train, TOP_N, train=F.col("doc") % 10 < 8)
    wide = T.tfidf_wide(tf_all, top, d, "doc_id", TOP_N)
    return wide.select("doc_id", *[r6(f"tfidf_{i}") for i in range(TOP_N)])


TFIDF_WIDE_SQL = "WITH " + TOK_CTE + """,
sel AS (SELECT wts.doc, top.idx, wts.weight FROM wts JOIN top ON top.term = wts.term)
SELECT d.doc_id, """ + ",\n  ".join(
    f"round(coalesce(max(CASE WHEN sel.idx = {i} THEN sel.weight END), 0.0), 6) AS tfidf_{i}"
    for i in range(TOP_N)) + """
FROM documents d LEFT JOIN sel ON sel.doc = d.doc_id GROUP BY d.doc_id"""


def tfidf_hashed(spark, sf):
    d = _docs(spark, sf)
    wide, _dims = T.hashed_tfidf(d, "doc_id", "text", F.col("doc_id") % 10 < 8,
                                 num_features=1000, top_n=TOP_N)
    return wide


def mojibake_report(spark, sf):
    """Damage by source; every tenth document is its own UTF-8 bytes read as Latin-1."""
    misread = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    d = table(spark, sf, "documents").select(
        "source", F.when(F.col("doc_id") % 10 == 0, misread).otherwise(F.col("text")).alias("text"))
    return T.mojibake_report(d, "text", "source")


# fixed values: the characters of the bytes 0x80 to 0x9F in the Windows code page, the five free ones left out
_CP1252 = {b: bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}
_CASES = " ".join(f"WHEN {ord(c)} THEN '{b:02X}'" for b, c in _CP1252.items())
MOJIBAKE_SQL = f"""
WITH hexed AS (SELECT doc_id, source, text, regexp_extract_all(hex(encode(text)), '..') AS h FROM documents),
damaged AS (SELECT doc_id, source, CASE WHEN doc_id % 10 = 0
    THEN array_to_string(list_transform(h, lambda x: chr(CAST('0x' || x AS INTEGER))), '') ELSE text END AS t FROM hexed),
flagged AS (SELECT *, coalesce(contains(t, 'Ã') OR contains(t, 'â€') OR contains(t, 'Â'), false) AS bad FROM damaged),
codes AS (SELECT doc_id, source, t, list_transform(string_split(t, ''), lambda c: unicode(c)) AS u FROM flagged WHERE bad),
bytes AS (SELECT doc_id, t,
    list_transform(u, lambda x: CASE WHEN x < 128 OR x BETWEEN 160 AND 255 THEN printf('%02X', x) ELSE CASE x {_CASES} END END) AS w,
    list_transform(u, lambda x: CASE WHEN x < 256 THEN printf('%02X', x) END) AS l FROM codes),
fixed AS (SELECT doc_id, t,
    CASE WHEN len(list_filter(w, lambda x: x IS NULL)) = 0 THEN try(decode(unhex(array_to_string(w, '')))) END AS a,
    CASE WHEN len(list_filter(l, lambda x: x IS NULL)) = 0 THEN try(decode(unhex(array_to_string(l, '')))) END AS b FROM bytes)
SELECT source, count(*) AS n_rows, count(*) FILTER (WHERE bad) AS n_flagged,
       count(*) FILTER (WHERE coalesce(a <> f.t, false) OR coalesce(b <> f.t, false)) AS n_repaired
FROM flagged LEFT JOIN fixed f ON f.doc_id = flagged.doc_id GROUP BY source"""


QUERIES = {
    "token_counts": (token_counts, TOKEN_COUNTS_SQL),
    "tfidf_top_terms": (tfidf_top_terms, TFIDF_TOP_SQL),
    "idf_train_apply": (idf_train_apply, IDF_APPLY_SQL),
    "tfidf_wide": (tfidf_wide, TFIDF_WIDE_SQL),
    "tfidf_hashed": (tfidf_hashed, None),
    "mojibake_report": (mojibake_report, MOJIBAKE_SQL),
}
