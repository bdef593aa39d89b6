"""Exact ordered prefix sums and ranks without one-task groups.

A window ``sum(w) over (partition by g order by x)`` sends every row of a
group to one task; when one group holds a third of the data, so does that
task.  ``sorted_prefix`` computes the same exclusive prefix sum in bounded
pieces:

1. every row gets a *sub-bucket* ``b = bucket(x)``, a deterministic,
   order-preserving function of the value (log-scale for general numbers,
   the top bits for uniform hash keys), so equal values share a bucket and
   buckets are ordered like their values;
2. a window over (group, bucket) gives the prefix inside the bucket;
3. per (group, bucket) totals are one row per bucket; their exclusive running
   sum is the bucket's offset.

Because the bucket is a pure function of the row, the plan stays lazy (no
sampling pass), and a recomputation after a lost executor yields the same
buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def _cols(xs: str | Sequence[str]) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "inner") -> DataFrame:
    """Equi join on ``keys`` where NULL matches NULL (a NULL group is a group)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


LOG_BUCKETS_PER_E = 16384  # relative bucket width ~6e-5
HASH_BUCKET_BITS = 20  # 2^20 buckets over a uniform 60-bit key


def log_bucket(x: Column) -> Column:
    """Monotone non-decreasing bucket of a number: 0 for 0, positive for x > 0,
    negative for x < 0, width ~1/16384 in log scale (Java's log is
    semi-monotonic, so the floor of a scaled log is monotone).  Infinities and
    NaN (Spark's largest value) share the outermost buckets."""
    a = F.least(F.abs(x.cast("double")), F.lit(1.7e308))
    k = F.floor(F.log(a) * F.lit(LOG_BUCKETS_PER_E)) + F.lit(800 * LOG_BUCKETS_PER_E + 1)
    return F.when(x > 0, k).when(x < 0, -k).otherwise(F.lit(0)).cast("long")


def hash_bucket(h: Column) -> Column:
    """Top bits of a uniform non-negative 60-bit key."""
    return F.shiftright(h, 60 - HASH_BUCKET_BITS)


_ZERO = {"string": "", "boolean": False, "date": "1970-01-01"}


def _null_free(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Replace nullable key columns by (filled value, is-null flag) columns so
    that a plain equi join equals a null-safe one — and can reuse the hash
    partitioning of an earlier window on the same columns."""
    dtypes = dict(df.dtypes)
    keys: list[str] = []
    for i, c in enumerate(cols):
        t = dtypes[c]
        zero = _ZERO.get(t, 0)
        df = df.withColumn(f"__k{i}", F.coalesce(F.col(c), F.lit(zero).cast(t))) \
               .withColumn(f"__z{i}", F.col(c).isNull())
        keys += [f"__k{i}", f"__z{i}"]
    return df, keys


def sorted_prefix(df: DataFrame, part_cols: str | Sequence[str], order_col: str,
                  weights: dict[str, Column | str], tie_cols: Sequence[str] = (),
                  bucket: Column | None = None) -> DataFrame:
    """Add ``<name>`` = sum of ``weights[name]`` over rows of the same
    partition strictly before this row in (order_col, *tie_cols) order.

    ``bucket`` must be non-decreasing in ``order_col``; the default is
    :func:`log_bucket` of the (numeric) order column.  The in-bucket window and
    the join with the bucket offsets are keyed by the same columns, so the
    rows are shuffled once; only the small offsets table moves for the join."""
    part = _cols(part_cols)
    wcols = {f"__w_{n}": (F.col(v) if isinstance(v, str) else v) for n, v in weights.items()}
    x = F.col(order_col)
    b = bucket if bucket is not None else log_bucket(x)
    base = df.select("*", *[c.alias(n) for n, c in wcols.items()], b.alias("__b"))
    base, keys = _null_free(base, part)

    totals = base.groupBy(*keys, "__b").agg(*[F.sum(n).alias(f"{n}_t") for n in wcols])
    before_bucket = Window.partitionBy(*keys).orderBy("__b").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = totals.select(
        *keys, "__b",
        *[F.coalesce(F.sum(f"{n}_t").over(before_bucket), F.lit(0)).alias(f"{n}_o")
          for n in wcols])

    inside = Window.partitionBy(*keys, "__b").orderBy(x, *[F.col(t) for t in tie_cols]) \
        .rowsBetween(Window.unboundedPreceding, -1)
    within = base.select(
        "*", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"{n}_i") for n in wcols])

    out = within.join(offsets, [*keys, "__b"], "inner")
    result_cols = [(F.col(f"{n}_o") + F.col(f"{n}_i")).alias(name)
                   for name, n in zip(weights, wcols)]
    return out.select(*df.columns, *result_cols)


def average_rank(df: DataFrame, part_cols: str | Sequence[str], value_col: str,
                 weight_col: str | None = None, out_col: str = "rank",
                 **kw) -> DataFrame:
    """Average ranks with ties (1-based) of ``value_col`` within ``part_cols``
    for a table of *distinct* values; ``weight_col`` holds multiplicities
    (default 1).  Shuffles value counts, not rows."""
    w = F.col(weight_col) if weight_col else F.lit(1)
    pre = sorted_prefix(df, part_cols, value_col, {"__before": w}, **kw)
    return pre.withColumn(out_col, F.col("__before") + (w + F.lit(1)) / F.lit(2.0)) \
        .drop("__before")


def hash_order_key(*cols: Column | str, salt: Column | str | None = None) -> Column:
    """Order-preserving 60-bit integer of ``md5([salt ':'] cols...)``.

    Sorting by it (ties broken by the input key) reproduces ``ORDER BY md5(..)``;
    md5 is uniform, so its quantile cut points give balanced buckets."""
    parts: list[Column] = []
    if salt is not None:
        parts += [F.col(salt) if isinstance(salt, str) else salt, F.lit(":")]
    parts += [F.col(c) if isinstance(c, str) else c for c in cols]
    h = F.md5(F.concat(*[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def hashed_row_number(df: DataFrame, part_cols: str | Sequence[str], key_col: str,
                      salt: Column | str | None = None, out_col: str = "rn",
                      **kw) -> DataFrame:
    """0-based ``row_number() over (partition by part order by md5([salt:]key), key) - 1``,
    computed with bounded tasks.  Rows with the same 60-bit md5 prefix fall
    back to the full hex digest, then the key."""
    h = hash_order_key(key_col, salt=salt)
    full = F.md5(F.concat(*([] if salt is None else
                            [(F.col(salt) if isinstance(salt, str) else salt).cast("string"),
                             F.lit(":")]),
                          F.col(key_col).cast("string")))
    tmp = df.withColumn("__h", h).withColumn("__hx", full)
    out = sorted_prefix(tmp, part_cols, "__h", {out_col: F.lit(1)},
                        tie_cols=["__hx", key_col], bucket=hash_bucket(F.col("__h")), **kw)
    return out.drop("__h", "__hx")
