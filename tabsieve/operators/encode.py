"""Bayesian-smoothed target encoding over many-to-many bridge tables.

score(person) = (sum_y + k * gm) / (n + k) = n/(n+k) * mean + k/(n+k) * gm,
where gm is the mean label over *joined bridge rows* (not over entities).
An entity's encoding is the mean score of its persons; persons unseen in
training score gm; entities without persons get gm; member counts of
entities absent from the bridge are filled with 1.

Scale: every step is a hash aggregate with map-side combine or an equi join on
the person key; a prolific person (hot key) is pre-aggregated before it meets
the bridge, and AQE splits the skewed join partition.  The global mean is a
scalar subquery, never a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import hashed_row_number
from ..session import cut_lineage


def smoothed_scores(labeled: DataFrame, bridge: DataFrame, entity: str, person: str,
                    label: str, k: float = 20.0, written: bool = False) -> tuple[DataFrame, F.Column]:
    """Per-person smoothed score from training rows ``labeled(entity, label)``.

    Returns (scores(person, score), gm) with gm a scalar-subquery Column.
    ``written``: for scores applied more than once, the persons' sums are
    written and gm is a number, so no later plan joins the bridge to the labels."""
    joined = labeled.select(entity, label).join(
        bridge.select(entity, person).where(F.col(person).isNotNull()), entity, "inner")
    stats = joined.groupBy(person).agg(F.count(F.lit(1)).alias("__n"),
                                       F.sum(F.col(label).cast("double")).alias("__s"))
    mean = F.try_divide(F.sum("__s"), F.sum("__n"))
    if written:
        stats = cut_lineage(stats)
        gm = F.lit(stats.select(mean).first()[0]).cast("double")
    else:  # over the same per-person aggregate, whose exchange is reused
        gm = stats.select(mean).scalar()
    scores = stats.select(person, ((F.col("__s") + F.lit(k) * gm)
                                   / (F.col("__n") + F.lit(k))).alias("__score"))
    return scores, gm


def apply_scores(target: DataFrame, bridge: DataFrame, scores: DataFrame, gm: F.Column,
                 entity: str, person: str, out_col: str,
                 count_col: str | None = None) -> DataFrame:
    """Mean person score per entity joined onto ``target``; defaults gm / 1."""
    return join_encodings(target, entity_scores(bridge, scores, gm, entity, person), gm, entity, out_col, count_col)


def entity_scores(bridge: DataFrame, scores: DataFrame, gm: F.Column, entity: str, person: str) -> DataFrame:
    """(entity, __enc, __cnt): mean person score and members of every entity of the bridge."""
    per_row = bridge.select(entity, person).join(scores, person, "left")
    return per_row.groupBy(entity).agg(
        F.avg(F.coalesce(F.col("__score"), gm)).alias("__enc"),
        F.count(F.lit(1)).alias("__cnt"))


def join_encodings(target: DataFrame, per_entity: DataFrame, gm: F.Column, entity: str, out_col: str,
                   count_col: str | None = None) -> DataFrame:
    """:func:`entity_scores` joined onto ``target``; defaults gm / 1."""
    out = target.join(per_entity, entity, "left")
    cols = [c for c in target.columns if c not in (out_col, count_col)]
    res = [F.coalesce(F.col("__enc"), gm).alias(out_col)]
    if count_col:
        res.append(F.coalesce(F.col("__cnt"), F.lit(1)).cast("long").alias(count_col))
    return out.select(*cols, *res)


def target_encode(train: DataFrame, target: DataFrame, bridge: DataFrame, entity: str,
                  person: str, label: str, out_col: str, count_col: str | None = None,
                  k: float = 20.0) -> DataFrame:
    """Fit on ``train`` labels, apply to ``target`` entities."""
    scores, gm = smoothed_scores(train, bridge, entity, person, label, k)
    return apply_scores(target, bridge, scores, gm, entity, person, out_col, count_col)


def out_of_fold_encode(labeled: DataFrame, bridge: DataFrame, entity: str, person: str,
                       label: str, fold: str, out_col: str, k: float = 20.0) -> DataFrame:
    """Leak-free encoding: each entity of fold f is scored with statistics of
    the other folds only, equal to k separate fits but in one pass.

    per (person, fold) sums are subtracted from per-person totals; the
    per-fold global means come from a k-row table.  Returns
    ``labeled`` columns + ``out_col``.
    """
    lab = labeled.select(entity, fold, F.col(label).cast("double").alias("__y"))
    br = bridge.select(entity, person).where(F.col(person).isNotNull())
    rows = br.join(lab, entity, "inner")  # bridge rows of labelled entities

    # per (person, fold) sums, with the person's totals beside them (k rows a person)
    of_person = Window.partitionBy(person)
    pf = rows.groupBy(person, fold).agg(F.count(F.lit(1)).alias("__npf"), F.sum("__y").alias("__spf"))
    pf = pf.withColumn("__np", F.sum("__npf").over(of_person)).withColumn("__sp", F.sum("__spf").over(of_person))

    per_fold = pf.groupBy(fold).agg(F.sum("__npf").alias("__nf"), F.sum("__spf").alias("__sf"))
    tot_n = per_fold.select(F.sum("__nf")).scalar()
    tot_s = per_fold.select(F.sum("__sf")).scalar()
    # held-out global mean per fold: bridge rows of the other folds
    folds = lab.select(fold).distinct()  # k rows
    gm = (folds.join(per_fold, fold, "left")
          .select(fold, F.try_divide(tot_s - F.coalesce(F.col("__sf"), F.lit(0.0)),
                                     tot_n - F.coalesce(F.col("__nf"), F.lit(0))).alias("__gm")))

    # every bridge row of a labelled entity meets its person's row of the entity's fold
    scored = (rows.select(entity, person, fold)
              .join(pf, [person, fold], "inner")
              .join(F.broadcast(gm), fold, "inner")  # k rows: bounded by the fold count
              .select(entity, fold, "__gm", (F.col("__np") - F.col("__npf")).alias("__n"),
                      (F.col("__sp") - F.col("__spf")).alias("__s")))
    scored = scored.select(entity, F.when(
        F.col("__n") > 0,
        (F.col("__s") + F.lit(k) * F.col("__gm")) / (F.col("__n") + F.lit(k)))
        .otherwise(F.col("__gm")).alias("__score"))
    per_entity = scored.groupBy(entity).agg(F.avg("__score").alias("__enc"))
    return (labeled.join(per_entity, entity, "left")
            .join(F.broadcast(gm), fold, "left")
            .withColumn(out_col, F.coalesce(F.col("__enc"), F.col("__gm")))
            .drop("__enc", "__gm"))


def _fold_stats(rows: DataFrame, person: str, fold: str, fold_ids: list) -> DataFrame:
    """(person, __n<i>, __s<i>): rows and label sum of the folds other than the
    i-th, from (person, fold, __y).  Sums per (person, fold) come first: the
    2 k columns are shuffled once a (person, fold), not once a bridge row."""
    pf = rows.groupBy(person, fold).agg(F.count(F.lit(1)).alias("__npf"), F.sum("__y").alias("__spf"))
    other = {i: F.col(fold) != F.lit(v) for i, v in enumerate(fold_ids)}
    return pf.groupBy(person).agg(*[x for i, c in other.items() for x in (
        F.sum(F.when(c, F.col("__npf")).otherwise(0)).alias(f"__n{i}"),
        F.sum(F.when(c, F.col("__spf")).otherwise(0.0)).alias(f"__s{i}"))])


def _fold_scores(stats: DataFrame, person: str, n: int, k: float, gm: list) -> DataFrame:
    """(person, __e<i>): the smoothed scores of the n iterations."""
    return stats.select(person, *[F.when(
        F.col(f"__n{i}") > 0, (F.col(f"__s{i}") + F.lit(k) * gm[i]) / (F.col(f"__n{i}") + F.lit(k)))
        .otherwise(gm[i]).alias(f"__e{i}") for i in range(n)])


def _fold_means(per_row: DataFrame, entity: str, n: int) -> DataFrame:
    """(entity, __cnt, __e<i>): rows and mean scores; one count serves all means."""
    sums = per_row.groupBy(entity).agg(F.count(F.lit(1)).alias("__cnt"),
                                       *[F.sum(f"__e{i}").alias(f"__e{i}") for i in range(n)])
    return sums.select(entity, "__cnt", *[(F.col(f"__e{i}") / F.col("__cnt")).alias(f"__e{i}") for i in range(n)])


def fold_encodings(labeled: DataFrame, bridge: DataFrame, entity: str, person: str, label: str, fold: str,
                   fold_ids: list, k: float = 20.0) -> tuple[DataFrame, list[float | None]]:
    """((entity, __cnt, __e<i>), gm): for every entity of the bridge and every fold what
    :func:`smoothed_scores` of the other folds' rows and :func:`entity_scores`
    give, in one pass over the bridge.  A person's sums are written once."""
    lab = labeled.select(entity, fold, F.col(label).cast("double").alias("__y"))
    br = bridge.select(entity, person)
    rows = br.where(F.col(person).isNotNull()).join(lab, entity, "inner").select(person, fold, "__y")
    stats = cut_lineage(_fold_stats(rows, person, fold, fold_ids))
    n = len(fold_ids)
    means = stats.agg(*[F.try_divide(F.sum(f"__s{i}"), F.sum(f"__n{i}")).alias(f"m{i}") for i in range(n)]).first()
    gm = [F.lit(m).cast("double") for m in means]  # k numbers
    per_row = br.join(_fold_scores(stats, person, n, k, gm), person, "left").select(
        entity, *[F.coalesce(F.col(f"__e{i}"), gm[i]).alias(f"__e{i}") for i in range(n)])
    return _fold_means(per_row, entity, n), list(means)


def fold_iteration_encode(labeled: DataFrame, bridge: DataFrame, entity: str, person: str,
                          label: str, fold: str, out_col: str, count_col: str | None = None,
                          k: float = 20.0, wide: bool = False) -> DataFrame:
    """All k cross-validation iterations in one pass.

    Returns (``fold_iter``, entity, ``out_col`` [, ``count_col``]) for every
    labelled entity and every fold f: the encoding fitted on the rows of the
    other folds (what refitting an encoder on ``fold != f`` and applying it to
    every entity gives).  Rows with ``fold_iter == fold`` are the out-of-fold
    encodings.  A person's k scores, from totals minus per-fold sums, are k
    columns of one row, so the bridge is joined once and averaged per entity;
    the iterations become rows only after that.

    ``wide``: they stay columns instead, ``<out_col>__<i>`` for the i-th of the
    sorted folds, one row per labelled row."""
    lab = labeled.select(entity, fold, F.col(label).cast("double").alias("__y"))
    br = bridge.select(entity, person).where(F.col(person).isNotNull())
    rows = br.join(lab, entity, "inner")
    fold_ids = sorted(r[0] for r in lab.select(fold).distinct().collect())  # k values
    n = len(fold_ids)
    stats = _fold_stats(rows, person, fold, fold_ids)
    gm = [stats.select(F.try_divide(F.sum(f"__s{i}"), F.sum(f"__n{i}"))).scalar() for i in range(n)]
    scores = _fold_scores(stats, person, n, k, gm)
    per_entity = _fold_means(rows.select(entity, person).join(scores, person, "inner"), entity, n)
    out = lab.select(entity).join(per_entity, entity, "left")
    encs = [F.coalesce(F.col(f"__e{i}"), gm[i]) for i in range(n)]
    count = [F.coalesce(F.col("__cnt"), F.lit(1)).cast("long").alias(count_col)] if count_col else []
    if wide:
        return out.select(entity, *[e.alias(f"{out_col}__{i}") for i, e in enumerate(encs)], *count)
    out = out.select(entity, "__cnt", F.explode(F.array(*[F.struct(
        F.lit(v).alias("fold_iter"), encs[i].alias("enc")) for i, v in enumerate(fold_ids)])).alias("__it"))
    return out.select(F.col("__it.fold_iter").alias("fold_iter"), entity, F.col("__it.enc").alias(out_col), *count)


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: str = "",
                     out_col: str = "fold") -> DataFrame:
    """fold = (row_number over (partition by label order by md5(seed||key), key) - 1) % k.

    Classes are balanced to +-1 per fold; the row number is computed with
    bounded tasks even though one class may hold most rows."""
    salt = F.lit(seed) if seed else None
    ranked = hashed_row_number(df, label, key, salt=salt, out_col="__rn")
    return ranked.withColumn(out_col, (F.col("__rn") % F.lit(k)).cast("int")).drop("__rn")
