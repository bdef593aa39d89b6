"""TF-IDF on whole texts, term-level and hashed.

Term-level plan (SQL-checkable): tokens = split(lower(text), '\\s+') without
empty strings, stop words removed by a broadcast anti join (the stop list is a
fixed, bounded table), tf per (doc, term), document frequency per term over the
*training* docs, ``idf = ln((N_train + 1) / (df + 1))``.

The mass that ranks terms, sum over training docs of tf * idf, equals
``idf(term) * total_tf(term)``, so top terms come from one per-term aggregate
with no join back to the (doc, term) table and no collect of vectors.

Hashed plan (Spark ML, the original feature space): Tokenizer ->
StopWordsRemover -> HashingTF(1000) -> IDF fitted on training docs; the L1 mass
per dimension comes from ``Summarizer`` (a distributed tree aggregate), and the
chosen dimensions are extracted in one ``select`` of ``vector_to_array``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.textfold import has_mojibake, mojibake_repaired_udf


def tokens(docs: DataFrame, id_col: str, text_col: str,
           stop_words: Sequence[str] | None = None) -> DataFrame:
    """(id, term) one row per token occurrence of the whole text."""
    t = docs.select(F.col(id_col).alias("doc"),
                    F.explode(F.split(F.lower(F.col(text_col)), r"\s+")).alias("term")) \
        .where(F.col("term") != "")
    if stop_words:
        stops = docs.sparkSession.createDataFrame([(w,) for w in stop_words], "term string")
        t = t.join(F.broadcast(stops), "term", "left_anti")  # bounded: the stop list
    return t


def term_freqs(tok: DataFrame) -> DataFrame:
    """(doc, term, tf)."""
    return tok.groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf"))


def term_stats(tf: DataFrame) -> DataFrame:
    """(term, total, df) over the given docs."""
    return tf.groupBy("term").agg(F.sum("tf").alias("total"), F.count(F.lit(1)).alias("df"))


def idf_column(df: Column, n_docs: Column) -> Column:
    return F.log((n_docs + F.lit(1.0)) / (df + F.lit(1.0)))


def top_terms(tf: DataFrame, n_train: Column, top_n: int = 50,
              train: Column | None = None) -> DataFrame:
    """(term, idf, mass, idx) for the ``top_n`` terms by training L1 mass;
    ties by term; ``idx`` = 0..top_n-1 (the column index).

    ``train`` flags training rows of ``tf`` (all rows when None), so callers
    can pass the one (doc, term, tf) table they also use for weights and the
    token scan is shared."""
    t = F.lit(True) if train is None else train
    st = (tf.groupBy("term")
          .agg(F.sum(F.when(t, F.col("tf"))).alias("total"), F.count_if(t).alias("df"))
          .where(F.col("df") > 0))
    idf = idf_column(F.col("df"), n_train)
    ranked = st.select("term", idf.alias("idf"), (F.col("total") * idf).alias("mass"))
    top = ranked.orderBy(F.desc("mass"), F.asc("term")).limit(top_n)
    # the top table has top_n rows; numbering it is a bounded single-task window
    from pyspark.sql import Window
    return top.withColumn("idx", F.row_number().over(
        Window.orderBy(F.desc("mass"), F.asc("term"))) - 1)


def tfidf_weights(tf_all: DataFrame, tf_train: DataFrame, n_train: Column) -> DataFrame:
    """(doc, term, weight) for every doc with the training IDF; terms never seen
    in training get df = 0."""
    dfs = tf_train.groupBy("term").agg(F.count(F.lit(1)).alias("df")).hint("shuffle_hash")  # a row a term: no sort of tf
    j = tf_all.join(dfs, "term", "left")
    return j.select("doc", "term",
                    (F.col("tf") * idf_column(F.coalesce(F.col("df"), F.lit(0)), n_train))
                    .alias("weight"))


def tfidf_wide(tf_all: DataFrame, top: DataFrame, docs: DataFrame, id_col: str,
               top_n: int, prefix: str = "tfidf_") -> DataFrame:
    """One column per top term (0 when absent), every doc kept.  Only the
    ``top_n`` chosen terms are joined (a broadcast of ``top_n`` rows carrying
    their IDF), so the vocabulary is never joined to the (doc, term) table."""
    sel = tf_all.join(F.broadcast(top.select("term", "idx", "idf")), "term", "inner") \
        .select("doc", "idx", (F.col("tf") * F.col("idf")).alias("weight"))
    wide = sel.groupBy("doc").pivot("idx", list(range(top_n))).agg(F.first("weight"))
    cols = [F.coalesce(F.col(str(i)), F.lit(0.0)).alias(f"{prefix}{i}") for i in range(top_n)]
    return (docs.select(F.col(id_col).alias("doc")).join(wide, "doc", "left")
            .select(F.col("doc").alias(id_col), *cols))


def hashed_tfidf(docs: DataFrame, id_col: str, text_col: str, train: Column,
                 num_features: int = 1000, top_n: int = 50, prefix: str = "tfidf_"):
    """Spark ML pipeline in the hashed space; returns (wide DataFrame with
    ``top_n`` dimension columns, list of chosen dimension indices)."""
    from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.stat import Summarizer

    base = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("__t"),
                       train.alias("__train"))
    tok = Tokenizer(inputCol="__t", outputCol="__w")
    rem = StopWordsRemover(inputCol="__w", outputCol="__f")
    htf = HashingTF(inputCol="__f", outputCol="__tf", numFeatures=num_features)
    feats = htf.transform(rem.transform(tok.transform(base)))
    model = IDF(inputCol="__tf", outputCol="__v").fit(feats.where("__train"))
    vec = model.transform(feats)
    mass = (vec.where("__train").select(Summarizer.metrics("normL1").summary(F.col("__v")).alias("s"))
            .first()["s"]["normL1"].toArray())  # num_features numbers
    order = sorted(range(num_features), key=lambda i: (-mass[i], i))[:top_n]
    arr = vector_to_array(F.col("__v"))
    wide = vec.select(F.col(id_col), *[arr[d].alias(f"{prefix}{i}") for i, d in enumerate(order)])
    return wide, order


def mojibake_report(docs: DataFrame, text_col: str, group_col: str) -> DataFrame:
    """Per group: rows, rows with the UTF-8-as-Latin-1 signature, rows the
    strict round trip repaired.  The UDF only runs on flagged rows."""
    flagged = has_mojibake(text_col)
    repaired = F.when(flagged, mojibake_repaired_udf(F.col(text_col))).otherwise(F.lit(False))
    return docs.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(flagged).alias("n_flagged"),
        F.count_if(repaired).alias("n_repaired"))
