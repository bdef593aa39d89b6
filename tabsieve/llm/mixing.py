"""Mixing sources to target weights by Pareto order sampling.

1. :func:`allocate` gives every source a target in words: the sources, in code
   point order (NULL last), weigh 5, 2, 1, 5, 2, 1, ... and share ``ratio``
   times all words; no target exceeds ``cap`` times its source, and the excess
   goes to the others by weight (the water level is found by one running sum
   over the sources ordered by cap / weight).
2. A document's expected copies are target / source size (times its ``tilt``,
   at most ``cap``).  The whole part is taken for certain; the fractional part
   is its inclusion probability ``l``.  With ``u`` uniform (a hash of seed and
   id, so reruns agree), documents are ranked by Pareto's ratio of odds
   ``q = (u / (1 - u)) / (l / (1 - l))`` and the lowest are taken until the
   source's words are used up: a sample of fixed size in words, off by at most
   half of one document.

The rank cut is found without sorting a source: words are summed per (source,
1/65536 of the monotone image q / (1 + q)), only the bucket in which a source's
words run out is ranked row by row, and the last document taken becomes the
source's cutoff.  Applying a plan is then a row-wise comparison against a table
with one row per source; no text is shuffled.

Defined cases: NULL text or no word has size 0 and is ranked like any other;
NULL sources form one source, NULL ids hash like the empty string; ties and
repeated rows rank by (q, id, hash of the text), so equal rows are cut at the
same place together; an empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import join_null_safe
from ..session import cut_lineage
from .common import words

RATIO, CAP, WEIGHTS, SEED = 1.5, 2.0, (5, 2, 1), "mix"
BUCKETS = 65536
MAX_BROADCAST = 50_000  # sources, about 100 bytes each
BITS = 52


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """Uniform in (0, 1): the first 52 bits of md5(seed:id), at mid step."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    n = F.conv(F.substring(h, 1, BITS // 4), 16, 10).cast("long").cast("double")
    return (n + F.lit(0.5)) / F.lit(float(1 << BITS))


def allocate(sizes: DataFrame, ratio: float = RATIO, cap: float = CAP,
             weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size) -> the same with ``target``; one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rn") - 1) % len(weights) + 1)
    by_fill = Window.orderBy("fill", "rn")
    before, rest = by_fill.rowsBetween(Window.unboundedPreceding, -1), by_fill.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    df = sizes.withColumn("rn", F.row_number().over(by_name)).withColumn("weight", weight) \
        .withColumn("ceiling", F.col("source_size") * F.lit(cap)) \
        .withColumn("fill", F.col("ceiling") / F.col("weight")) \
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(ratio)) \
        .withColumn("level", (F.col("total") - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)))
                    / F.sum("weight").over(rest)) \
        .withColumn("water", F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", "rn", "level")))
                    .over(everything)["level"])
    return df.select("source", "source_size", F.coalesce(
        F.least("ceiling", F.col("weight") * F.col("water")), F.col("ceiling")).alias("target"))


def _keys(docs: DataFrame, id_col: str, text_col: str, source_col: str, tilt: Column | None, seed: str) -> DataFrame:
    text = F.col(text_col)
    return docs.select("*", F.struct(
        F.col(source_col).alias("source"), F.size(words(text)).cast("long").alias("size"),
        (tilt if tilt is not None else F.lit(1.0)).cast("double").alias("tilt"),
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
        F.xxhash64(text).alias("tie"), uniform(F.col(id_col), seed).alias("u")).alias("__k"))


def _shares(rate: Column, cap: float) -> tuple[Column, Column, Column]:
    """Whole copies, inclusion probability and q of a document."""
    copies = F.least(rate * F.col("__k.tilt"), F.lit(cap))
    whole = F.floor(copies)
    odds = (copies - whole) / (F.lit(1.0) - (copies - whole))
    u = F.col("__k.u")
    q = F.when(odds > 0, u / (F.lit(1.0) - u) / odds).otherwise(F.lit(float("inf")))
    return whole, copies - whole, q


def _small(sources: DataFrame) -> DataFrame:
    """A written table with a row per source, to be broadcast if it has few
    rows; else Spark joins it by source and may split a large source's side."""
    return F.broadcast(sources) if sources.count() <= MAX_BROADCAST else sources


def plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         tilt: Column | None = None, ratio: float = RATIO, cap: float = CAP,
         weights: tuple[int, ...] = WEIGHTS, seed: str = SEED) -> DataFrame:
    """One row per source: source, source_size, target, rate (expected copies
    of a document of tilt 1) and cutoff, the (q, id, tie) of the last document
    taken beyond the whole copies (NULL: none)."""
    k = cut_lineage(_keys(docs, id_col, text_col, source_col, tilt, seed).select("__k"))
    by_source = k.groupBy(F.col("__k.source").alias("source")).agg(
        F.sum("__k.size").alias("source_size"),
        F.sum(F.col("__k.size") * F.col("__k.tilt")).alias("tilted"))
    targets = join_null_safe(allocate(by_source.select("source", "source_size"), ratio, cap, weights),
                             by_source.select("source", "tilted"), ["source"])
    rates = targets.select("source", "source_size", "target", F.coalesce(
        F.try_divide("target", "tilted"), F.lit(0.0)).alias("rate"))
    rates = _small(cut_lineage(rates))
    whole, part, q = _shares(F.col("rate"), cap)
    ranked = join_null_safe(k.withColumn("source", F.col("__k.source")), rates, ["source"]).select(
        "source", "rate", "target", F.col("__k.size").alias("size"), whole.alias("whole"),
        F.struct(q.alias("q"), F.col("__k.id").alias("id"), F.col("__k.tie").alias("tie")).alias("key"),
        F.when(F.isnan(q / (1 + q)) | (q == float("inf")), F.lit(BUCKETS))
        .otherwise(F.floor(q / (1 + q) * BUCKETS)).cast("int").alias("bucket"))
    sums = ranked.groupBy("source", "bucket").agg(F.sum("size").alias("words"),
                                                  F.sum(F.col("size") * F.col("whole")).alias("sure"))
    s = Window.partitionBy("source")
    upto = s.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    sums = join_null_safe(sums.withColumn("sure", F.sum("sure").over(s)).withColumn("upto", F.sum("words").over(upto)),
                          rates.select("source", "target"), ["source"]) \
        .withColumn("need", F.col("target") - F.col("sure"))
    # the bucket in which the words run out; one row per source
    edge = sums.filter((F.col("need") > F.col("upto") - F.col("words")) & (F.col("need") <= F.col("upto"))) \
        .groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("before"), "need")).alias("e")) \
        .select("source", "e.*")
    inside = join_null_safe(ranked.select("source", "bucket", "size", "key"),
                            edge.withColumnRenamed("bucket", "edge"), ["source"]) \
        .filter(F.col("bucket") == F.col("edge"))
    # rows with equal keys are taken together
    inside = inside.groupBy("source", "key").agg(F.sum("size").alias("size"), F.first("before").alias("before"),
                                                 F.first("need").alias("need"))
    run = s.orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    end = F.col("before") + F.sum("size").over(run)
    inside = inside.withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    near = (F.col("end") <= F.col("need")) | ((F.col("start") < F.col("need"))
                                              & (F.col("end") - F.col("need") < F.col("need") - F.col("start")))
    last = inside.filter(near).groupBy("source").agg(F.max("key").alias("last"))
    # nothing taken inside the edge bucket: all of the buckets before it
    floor = F.struct(F.when(F.col("bucket") >= BUCKETS, F.lit(float("inf")))
                     .otherwise(F.col("bucket") / (F.lit(float(BUCKETS)) - F.col("bucket"))).alias("q"),
                     F.lit("").alias("id"), F.lit(-(1 << 63)).cast("long").alias("tie"))
    cut = join_null_safe(edge, last, ["source"], "left") \
        .select("source", F.coalesce(F.col("last"), floor).alias("cutoff"))
    return cut_lineage(join_null_safe(rates, cut, ["source"], "left"))


def apply(docs: DataFrame, planned: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          source_col: str = "source", tilt: Column | None = None, cap: float = CAP, seed: str = SEED) -> DataFrame:
    """``docs`` with a struct ``mix``: size, source_size, target, copies."""
    base = docs.drop("mix")
    k = _keys(base, id_col, text_col, source_col, tilt, seed)
    p = _small(planned).select(F.col("source").alias("__s"), F.struct("source_size", "target", "rate", "cutoff").alias("__p"))
    joined = k.join(p, F.col("__k.source").eqNullSafe(F.col("__s")))
    whole, part, q = _shares(F.col("__p.rate"), cap)
    key = F.struct(q.alias("q"), F.col("__k.id").alias("id"), F.col("__k.tie").alias("tie"))
    extra = F.when((part > 0) & (key <= F.col("__p.cutoff")), 1).otherwise(0)
    return joined.select(*base.columns, F.struct(
        F.col("__k.size").alias("size"), F.col("__p.source_size").alias("source_size"),
        F.col("__p.target").alias("target"), (whole + extra).cast("int").alias("copies")).alias("mix"))


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The mixed corpus: every document as often as it is taken, same columns."""
    out = apply(docs, plan(docs, **kw), **{k: v for k, v in kw.items() if k in (
        "id_col", "text_col", "source_col", "tilt", "cap", "seed")})
    return out.withColumn("mix", F.explode(F.array_repeat(F.lit(True), F.col("mix.copies")))).drop("mix")


def report(docs: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes) per document."""
    out = apply(docs, plan(docs, id_col=id_col, **kw), id_col=id_col, **{k: v for k, v in kw.items() if k in (
        "text_col", "source_col", "tilt", "cap", "seed")})
    m = F.col("mix")
    return out.select(F.col(id_col).alias("doc_id"), m["size"].alias("size"), m["source_size"].alias("source_size"),
                      m["target"].alias("target"), (m["size"] * m["copies"]).cast("long").alias("taken"))


SQL = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
           / {float(1 << BITS)}::DOUBLE AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
n AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM s),
w AS (SELECT *, CASE (rn - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight,
             source_size * {CAP}::DOUBLE AS ceiling FROM n),
f AS (SELECT *, ceiling / weight AS fill, sum(source_size) OVER () * {RATIO}::DOUBLE AS total FROM w),
l AS (SELECT *, (total - coalesce(sum(ceiling) OVER (ORDER BY fill, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY fill, rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
t AS (SELECT source, source_size, least(ceiling, weight * (SELECT arg_min(level, (fill, rn)) FROM l WHERE level <= fill)) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS copies FROM t),
k AS (SELECT d.doc_id, d.source, d.size, r.source_size, r.target, floor(r.copies) AS whole, r.copies - floor(r.copies) AS part,
             u / (1 - u) / ((r.copies - floor(r.copies)) / (1 - (r.copies - floor(r.copies)))) AS q
      FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
c AS (SELECT *, target - whole * source_size AS need,
             sum(size) OVER (PARTITION BY source ORDER BY q, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fin
      FROM k)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN part > 0 AND (fin <= need OR
         (fin - size < need AND fin - need < need - (fin - size))) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM c"""
