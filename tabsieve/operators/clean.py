"""Cleaning: typed parse, winsorize, bucket-median imputation, derived columns,
dedup and data-quality profiles.

Medians are exact and distributed: value counts per (group, value) are
shuffled (a hot group with few distinct values shrinks to a few rows), and the
middle position is found by the bounded prefix sum of
:mod:`tabsieve.functions.ranking`.  ``approx=True`` switches to
``percentile_approx`` (constant memory per group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.ranking import join_null_safe, sorted_prefix


def grouped_median(df: DataFrame, group_cols: Sequence[str], value_col: str,
                   out_col: str = "median", approx: bool = False,
                   accuracy: int = 10_000, all_groups: bool = True) -> DataFrame:
    """One row per group (one row overall when ``group_cols`` is empty):
    median of non-NULL values (mean of the two middle values for an even
    count).  ``all_groups`` adds all-NULL groups with a NULL median; callers
    that left-join the result anyway can skip that extra pass."""
    g = list(group_cols)
    vals = df.where(F.col(value_col).isNotNull())
    if approx:
        med = vals.groupBy(*g).agg(
            F.percentile_approx(F.col(value_col).cast("double"), 0.5, accuracy).cast("double")
            .alias(out_col))
    else:
        vc = vals.groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("__cnt"))
        pos = sorted_prefix(vc, g, value_col, {"__before": "__cnt"})
        if g:
            tot = vc.groupBy(*g).agg(F.sum("__cnt").alias("__total"))
            pos = join_null_safe(pos, tot, g)
            total = F.col("__total")
        else:  # whole column: the count is a scalar subquery, not a join
            total = vc.select(F.sum("__cnt")).scalar()
        lo = F.floor((total + 1) / 2)
        hi = F.ceil((total + 1) / 2)
        holds = lambda p: (F.col("__before") < p) & (p <= F.col("__before") + F.col("__cnt"))
        med = pos.groupBy(*g).agg(
            ((F.max(F.when(holds(lo), F.col(value_col))).cast("double")
              + F.max(F.when(holds(hi), F.col(value_col))).cast("double")) / 2).alias(out_col))
    if not g or not all_groups:
        return med
    return join_null_safe(df.select(*g).distinct(), med, g, "left")


def impute_bucket_median(df: DataFrame, year_col: str, fills: dict[str, dict],
                         width: int = 10, compat: bool = False,
                         approx: bool = False) -> DataFrame:
    """``MEDIAN(x) OVER (PARTITION BY bucket(year))`` fill for each column of
    ``fills``: ``{col: {"round_int": bool, "cap": float|None, "null_policy": str}}``.

    The NULL bucket is one group.  Instead of one window per column (one task
    per bucket), the columns are stacked into (bucket, column, value) rows,
    all medians come from one distributed selection, and one join on the
    bucket (a table as small as the year domain) brings them back."""
    cols = list(fills)
    base = df.withColumn("__bucket", S.time_bucket(year_col, width, compat=compat))
    stacked = base.select("__bucket", F.explode(F.array(*[
        F.struct(F.lit(c).alias("__c"), F.col(c).cast("double").alias("__v")) for c in cols]))
        .alias("__kv")).select("__bucket", "__kv.__c", "__kv.__v")
    med = grouped_median(stacked, ["__bucket", "__c"], "__v", "__med", approx=approx,
                         all_groups=False)
    wide = med.groupBy("__bucket").pivot("__c", cols).agg(F.first("__med"))
    wide = wide.select("__bucket", *[F.col(c).alias(f"__med_{i}") for i, c in enumerate(cols)])
    out = join_null_safe(base, wide, ["__bucket"], "left")
    for i, (col, opt) in enumerate(fills.items()):
        m = F.col(f"__med_{i}")
        if opt.get("round_int"):
            m = S.round_half_even_int(m)
        filled = F.coalesce(F.col(col), m.cast(dict(df.dtypes)[col]))
        if opt.get("cap") is not None:
            filled = S.winsorize(filled, None, opt["cap"], opt.get("null_policy", "keep"))
        out = out.withColumn(col, filled)
    return out.drop("__bucket", *[f"__med_{i}" for i in range(len(cols))])


def derive_features(df: DataFrame, ref_year: int = 2026, short_runtime: int = 90,
                    compat: bool = False, year: str = "year", runtime: str = "runtime",
                    votes: str = "votes", primary: str | None = None,
                    original: str | None = None) -> DataFrame:
    """log_votes, film_age, votes_per_minute, runtime_short, votes_x_runtime
    and (when titles are given) is_foreign."""
    lv = F.log1p(F.col(votes))
    cols = [lv.alias("log_votes"),
            S.age_from_year(year, ref_year, compat=compat).alias("film_age"),
            S.safe_ratio(votes, runtime).alias("votes_per_minute"),
            S.flag(F.col(runtime) < short_runtime).alias("runtime_short"),
            (lv * F.col(runtime)).alias("votes_x_runtime")]
    if primary and original:
        cols.append(S.differs_flag(original, primary).alias("is_foreign"))
    return df.select("*", *cols)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row DISTINCT (rows differing in any column all survive)."""
    return df.distinct()


def sortable_micros(x: Column, dtype: str) -> Column:
    """Order-preserving BIGINT of a date/time value.  Wall-clock
    ``timestamp_ntz`` values are converted field by field, so the session
    time zone (and its DST gaps) cannot reorder them."""
    if dtype == "timestamp":
        return F.unix_micros(x)
    day = F.unix_date(F.to_date(x)).cast("long") * F.lit(86_400_000_000)
    if dtype == "date":
        return day
    secs = F.extract(F.lit("SECOND"), x)  # seconds with microseconds
    return (day + F.hour(x).cast("long") * F.lit(3_600_000_000)
            + F.minute(x).cast("long") * F.lit(60_000_000)
            + (secs * F.lit(1_000_000)).cast("long"))


def dedup_first(df: DataFrame, keys: Sequence[str],
                order: Sequence[tuple[str, str]]) -> DataFrame:
    """Deterministic keep-first per key; ``order`` = [(column, 'asc'|'desc')].

    Implemented as ``min_by(row, sort key)`` in a hash aggregate, so a hot key
    is combined map-side instead of sorted in one task.  A NULL in a sort
    column comes after every value.  Descending keys must be numeric, date or
    timestamp (they are negated).  Rows equal in the order go by their other
    columns, those of sortable types, in column order."""
    dtypes = dict(df.dtypes)
    parts = []
    for c, direction in order:
        x = F.col(c)
        t = dtypes[c]
        if t in ("timestamp_ntz", "timestamp", "date"):
            x = sortable_micros(x, t)
        elif direction == "desc" and t == "string":
            raise TypeError(f"descending string key {c} is not supported")
        parts += [F.col(c).isNull().alias(f"null_{c}"), (-x if direction == "desc" else x).alias(f"key_{c}")]
    payload = [c for c in df.columns if c not in keys]
    ties = [F.col(c).alias(f"tie_{i}") for i, c in enumerate(payload) if "map<" not in dtypes[c] and dtypes[c] != "variant"]
    return (df.groupBy(*keys)
            .agg(F.min_by(F.struct(*payload), F.struct(*parts, *ties)).alias("__first"))
            .select(*keys, "__first.*"))


def null_profile(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One pass, one row: ``n_rows`` and ``count_if(cond)`` per named check."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  *[F.count_if(c).alias(n) for n, c in checks.items()])


def dup_profile(df: DataFrame, key: str, approx: bool = False) -> DataFrame:
    """n_raw, n_unique (exact or HyperLogLog) and the integer duplication factor."""
    uniq = F.approx_count_distinct(key) if approx else F.count_distinct(key)
    return (df.agg(F.count(F.lit(1)).alias("n_raw"), uniq.alias("n_unique"))
            .withColumn("dup_factor", F.floor(F.try_divide("n_raw", "n_unique")).cast("long")))


def clean_split(raw: DataFrame, ref_year: int = 2026, width: int = 10, compat: bool = False,
                runtime_bounds: tuple[int, int] = (1, 210), votes_cap: float = 400000.0,
                approx: bool = False) -> DataFrame:
    """Raw title rows (text columns as in ``MOVIE_CSV_COLUMNS``) -> typed,
    clamped, bucket-median imputed, derived features and ``title_clean``.

    ``compat=True`` reproduces the coded behaviour of the reference (exact-year
    buckets, NULL runtime/votes/age collapsing to the clamp bounds)."""
    from ..functions.textfold import text_fold
    policy = "floor" if compat else "keep"
    lo, hi = runtime_bounds
    typed = raw.select(
        "*",
        S.parse_int("startYear").alias("__year_raw"),
        S.parse_int("endYear").alias("__end_raw"),
        S.winsorize(S.parse_int("runtimeMinutes"), lo, hi, policy).alias("runtime"),
        S.parse_double("numVotes", sentinel=None).alias("votes"))
    typed = typed.withColumn("year", F.coalesce("__year_raw", "__end_raw"))
    imputed = impute_bucket_median(typed, "year", {
        "runtime": {"round_int": True},
        "votes": {"cap": votes_cap, "null_policy": policy}}, width=width, compat=compat,
        approx=approx)
    feats = derive_features(imputed, ref_year=ref_year, compat=compat,
                            primary="primaryTitle", original="originalTitle")
    feats = feats.withColumn("title_clean", text_fold("primaryTitle"))
    return feats.drop("__year_raw", "__end_raw", "startYear", "endYear", "runtimeMinutes",
                      "numVotes", "primaryTitle", "originalTitle")
