"""Band joins, prior-history counts, normalised-title joins and nested-role
extraction.

None of these emits all pairs of a group:

* band join: the lookup is expanded to the ``2*tol+1`` years it can serve and
  reduced to the single best candidate per (title, year) *before* meeting the
  left side, so the join is many-to-one on (title, year);
* prior count: rows are pre-aggregated per (pair, day); the running count then
  walks at most one row per distinct day of a pair (a bounded date domain),
  instead of a self join or a per-row scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S


def band_join(left: DataFrame, lookup: DataFrame, left_title: str, left_year: str,
              right_title: str, right_year: str, rank: str, tol: int = 2,
              null_year_matches: bool = False, out_col: str = "matched_rank") -> DataFrame:
    """For each left row: the lookup row with equal title and |dyear| <= tol,
    nearest year first, then lowest ``rank``.  ``null_year_matches`` lets a
    lookup row with NULL year serve any year of its title, after in-band rows,
    and a left row with NULL year take the lowest rank of its title.
    """
    lk = lookup.select(F.col(right_title).alias("__t"), F.col(right_year).alias("__y"),
                       F.col(rank).alias("__r")).where(F.col("__t").isNotNull())
    offsets = F.array(*[F.lit(d) for d in range(-tol, tol + 1)])
    band = (lk.where(F.col("__y").isNotNull())
            .select("__t", "__y", "__r", F.explode(offsets).alias("__d"))
            .select("__t", (F.col("__y") + F.col("__d")).alias("__ty"),
                    F.abs("__d").alias("__dist"), "__r"))
    best = band.groupBy("__t", "__ty").agg(
        F.min(F.struct("__dist", "__r")).getField("__r").alias("__best"))
    cond = (F.col(left_title) == F.col("__t")) & (F.col(left_year) == F.col("__ty"))
    out = left.join(best, cond, "left").drop("__t", "__ty")
    if null_year_matches:
        nul = (lk.where(F.col("__y").isNull()).groupBy("__t")
               .agg(F.min("__r").alias("__nbest")))
        any_year = lk.groupBy("__t").agg(F.min("__r").alias("__abest"))
        nul = any_year.join(nul, "__t", "left")
        out = (out.join(nul, F.col(left_title) == F.col("__t"), "left").drop("__t")
               .withColumn("__best", F.coalesce("__best", "__nbest", F.when(F.col(left_year).isNull(), F.col("__abest"))))
               .drop("__nbest", "__abest"))
    return out.withColumnRenamed("__best", out_col)


def prior_count(rows: DataFrame, pair_cols: Sequence[str], day_col: str,
                out_col: str = "prior") -> DataFrame:
    """Per input row: rows of the same pair with a strictly earlier day.

    Equal to ``count(*) over (partition by pair order by day range between
    unbounded preceding and 1 preceding)`` and to the O(n^2) self join, but
    the window sees one row per (pair, day)."""
    pair = list(pair_cols)
    per_day = rows.groupBy(*pair, day_col).agg(F.count(F.lit(1)).alias("__c"))
    w = Window.partitionBy(*pair).orderBy(day_col).rowsBetween(Window.unboundedPreceding, -1)
    running = per_day.select(*pair, day_col,
                             F.coalesce(F.sum("__c").over(w), F.lit(0)).alias(out_col))
    return rows.join(running, [*pair, day_col], "left")


def title_key(c: Column | str) -> Column:
    """lower(strip(title)) — the key of a title equi join."""
    return F.lower(S.strip(c))


def title_join(left: DataFrame, right: DataFrame, left_title: str, right_title: str,
               how: str = "left") -> DataFrame:
    """Equi join on normalised titles; ``right`` must be unique per normalised
    title (aggregate it first), so the join is many-to-one."""
    r = right.withColumn("__tk", title_key(right_title)).drop(right_title)
    return left.withColumn("__tk", title_key(left_title)).join(r, "__tk", how).drop("__tk")


CREW_SCHEMA = "array<struct<job:string,name:string>>"


def parse_crew(c: Column | str) -> Column:
    """Python-literal list of dicts -> array<struct<job,name>>.  ``None``,
    ``True`` and ``False`` values are rewritten to JSON first."""
    s = F.col(c) if isinstance(c, str) else c
    for python, js in (("None", "null"), ("True", "true"), ("False", "false")):
        s = F.regexp_replace(s, rf":\s*{python}\s*([,}}])", f": {js}$1")
    return F.from_json(s, CREW_SCHEMA, {"allowSingleQuotes": "true"})


def names_with_role(crew: Column, role: str) -> Column:
    """Names whose job equals ``role`` case-insensitively, NULL names dropped;
    an unparsable list gives an empty array."""
    hit = F.filter(crew, lambda x: (F.lower(x["job"]) == F.lit(role.lower()))
                   & x["name"].isNotNull())
    return F.coalesce(F.transform(hit, lambda x: x["name"]), F.array().cast("array<string>"))


def pair_explode(df: DataFrame, a: str, b: str, a_out: str, b_out: str,
                 keep: Sequence[str]) -> DataFrame:
    """One row per (a, b) element pair *of the same row* (e.g. the directors
    x photographers of one film); rows with an empty side vanish."""
    return (df.select(*keep, F.explode(a).alias(a_out), b)
            .select(*keep, a_out, F.explode(b).alias(b_out)))


def fill_rank(df: DataFrame, col: str, lookup: DataFrame, rank: str) -> DataFrame:
    """Unmatched rank -> max(lookup rank) + 1 (a scalar subquery)."""
    mx = lookup.select(F.max(rank)).scalar()
    return df.withColumn(col, F.coalesce(F.col(col), mx + F.lit(1)))


__all__ = ["band_join", "prior_count", "title_join", "title_key", "parse_crew",
           "names_with_role", "pair_explode", "fill_rank", "curated_list_features"]


def curated_list_features(films: DataFrame, lookup: DataFrame, key: str = "tconst",
                          title_col: str = "title_clean", year_col: str = "year",
                          lookup_title: str = "title", lookup_year: str = "year",
                          rank_col: str = "rank", out_rank: str = "list_rank",
                          out_flag: str = "in_list", tol: int = 2,
                          null_year_matches: bool = False, unmatched: int | None = None) -> DataFrame:
    """Curated-list enrichment: titles normalised on both sides (one leading
    article stripped), band join on year within ``tol`` (nearest year, then
    best rank), unmatched films get flag 0 and the rank ``unmatched`` (a
    collection list's 0), by default ``max(rank) + 1``."""
    from ..functions.scalar import flag, title_norm
    left = films.select(key, title_norm(title_col).alias("__tn"),
                        F.col(year_col).cast("int").alias("__y"))
    lk = lookup.select(title_norm(lookup_title).alias("__lt"),
                       F.col(lookup_year).cast("string").try_cast("double").cast("int").alias("__ly"),
                       F.col(rank_col).cast("string").try_cast("double").cast("long").alias("__r")) \
        .where(F.col("__r").isNotNull())
    out = band_join(left, lk, "__tn", "__y", "__lt", "__ly", "__r", tol=tol,
                    null_year_matches=null_year_matches, out_col=out_rank)
    out = out.withColumn(out_flag, flag(F.col(out_rank).isNotNull()))
    out = fill_rank(out, out_rank, lk, "__r") if unmatched is None else out.fillna(unmatched, [out_rank])
    return out.select(key, out_rank, out_flag)
