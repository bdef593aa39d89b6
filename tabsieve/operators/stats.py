"""Distribution-free feature screening on the long form ``(id, y, feature, x)``.

Everything is grouped by ``feature`` (a few dozen keys) and computed from
*value counts* per (feature, x): the shuffle carries distinct values, not
rows, and ordered prefix sums go through the bounded
:func:`tabsieve.functions.ranking.sorted_prefix`.  Per-feature result tables
are tiny (one row per feature or feature pair); only those ever reach the
driver (the greedy redundancy walk).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranking import average_rank, log_bucket, sorted_prefix
from ..functions.special import EXACT_CELLS, EXACT_CLASS, digamma, exact_u_two_sided, normal_sf, student_t_two_sided
from ..session import cut_lineage, spread


# ---------------------------------------------------------------- long form
def to_long(df: DataFrame, id_col: str, label_col: str, features: Sequence[str]) -> DataFrame:
    """Wide -> long (id, y, feature, x double); NaN becomes NULL."""
    wide = df.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"),
                     *[F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")).alias(f) for f in features])
    return wide.unpivot(["id", "y"], list(features), "feature", "x")


def value_counts(long: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(feature, *extra, x, n, n0): multiplicity and class-0 count per value."""
    return long.groupBy("feature", *extra, "x").agg(
        F.count(F.lit(1)).alias("n"), F.sum(1 - F.col("y")).alias("n0"))


def ranked_values(long: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Value counts with the average (tie) rank of each value."""
    vc = value_counts(long, extra)
    return average_rank(vc, ["feature", *extra], "x", weight_col="n", out_col="rank")


def row_ranks(long: DataFrame) -> DataFrame:
    """(id, y, feature, x, rank) — average ranks attached to rows."""
    rv = ranked_values(long).select("feature", "x", "rank")
    return long.join(rv, ["feature", "x"], "inner")


# ------------------------------------------------------------ Mann-Whitney U
def mann_whitney(long: DataFrame) -> DataFrame:
    """Per feature: two-sided Mann-Whitney U of class 0 vs class 1 with tie
    correction and continuity 1/2 (normal approximation), and the effect
    ``1 - 2U/(n0 n1)``.  U is the class-0 statistic ``R0 - n0(n0+1)/2``.  A
    constant feature, or a missing class, has z NULL and p-value 1.

    The p-value is exact where a class has ``special.EXACT_CLASS`` rows at most, no
    value repeats and ``n0 n1`` is ``special.EXACT_CELLS`` at most."""
    rv = ranked_values(long)
    per = rv.groupBy("feature").agg(
        F.sum("n0").alias("n0"), F.sum(F.col("n") - F.col("n0")).alias("n1"),
        F.sum(F.col("rank") * F.col("n0")).alias("r0"),
        F.sum(F.pow(F.col("n").cast("double"), 3) - F.col("n")).alias("ties"))
    n0, n1, N = F.col("n0"), F.col("n1"), F.col("n0") + F.col("n1")
    u = F.col("r0") - n0 * (n0 + 1) / 2
    sigma = F.sqrt(n0 * n1 / 12.0 * ((N + 1) - F.try_divide("ties", N * (N - 1))))
    z = F.try_divide(F.abs(u - n0 * n1 / 2.0) - 0.5, sigma)
    exact = (F.least(n0, n1) > 0) & (F.least(n0, n1) <= EXACT_CLASS) & (F.col("ties") == 0) & (n0 * n1 <= EXACT_CELLS)
    return per.select("feature", "n0", "n1", u.alias("u"),
                      (1 - F.try_divide(2 * u, n0 * n1)).alias("effect"), z.alias("z"),
                      F.coalesce(exact_u_two_sided(F.when(exact, u.cast("long")), n0, n1),
                                 F.least(F.when(z.isNotNull(), F.lit(1.0)), 2 * normal_sf(z)), F.lit(1.0))
                      .alias("p_value"))


# ------------------------------------------------------- Benjamini-Hochberg
def bh_adjust(tests: DataFrame, p_col: str = "p_value", out_col: str = "p_adj",
              alpha: float | None = None, reject_col: str = "reject",
              key: str = "feature") -> DataFrame:
    """BH step-up adjusted p-values ``min(1, min_{j>=i} p_(j) n / j)``; tied p
    share one value.  ``reject = adj < alpha`` (strict).  The window has no
    partition but spans one row per *test* (features), not data rows."""
    order = Window.orderBy(F.col(p_col), F.col(key))
    n = F.count(F.lit(1)).over(Window.partitionBy())
    rn = F.row_number().over(order)
    t = tests.withColumn("__q", F.col(p_col) * n / rn)
    tail = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = t.withColumn(out_col, F.least(F.lit(1.0), F.min("__q").over(tail))).drop("__q")
    if alpha is not None:
        out = out.withColumn(reject_col, F.col(out_col) < F.lit(alpha))
    return out


# --------------------------------------------------------- mutual information
def rank_bins(long: DataFrame, bins: int = 10) -> DataFrame:
    """(id, y, feature, bin): bin = floor((avg_rank - 0.5) * B / N_feature);
    ties share a bin."""
    rv = ranked_values(long)
    tot = rv.groupBy("feature").agg(F.sum("n").alias("__N"))
    b = rv.join(tot, "feature").select(
        "feature", "x", F.floor((F.col("rank") - 0.5) * bins / F.col("__N")).cast("int").alias("bin"))
    return long.join(b, ["feature", "x"]).select("id", "y", "feature", "bin")


def mi_from_counts(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Plug-in MI (nats) from (keys..., bin, y, c) cell counts."""
    k = list(keys)
    wb = Window.partitionBy(*k, "bin")
    wy = Window.partitionBy(*k, "y")
    wa = Window.partitionBy(*k)
    cells = counts.select(*k, "c", F.sum("c").over(wb).alias("cb"),
                          F.sum("c").over(wy).alias("cy"), F.sum("c").over(wa).alias("N"))
    term = F.col("c") / F.col("N") * F.log(F.col("c") * F.col("N") / (F.col("cb") * F.col("cy")))
    return cells.groupBy(*k).agg(F.greatest(F.lit(0.0), F.sum(term)).alias("mi"))


def mi_binned(long: DataFrame, bins: int = 10) -> DataFrame:
    """Per feature: MI between rank bins of x and the label."""
    rb = rank_bins(long, bins)
    counts = rb.groupBy("feature", "bin", "y").agg(F.count(F.lit(1)).alias("c"))
    return mi_from_counts(counts, ["feature"])


def _perm_key(perm, id_col) -> "F.Column":
    return F.md5(F.concat(perm.cast("string"), F.lit(":"), F.col(id_col).cast("string")))


def _id_bytes(id_col: str) -> "F.Column":
    """An id as its md5 takes it, for :func:`perm_heads`."""
    return F.col(id_col).cast("string").cast("binary")


def _full_key(perm: int, key: bytes) -> bytes:
    return hashlib.md5(b"%d:%s" % (perm, key), usedforsecurity=False).hexdigest().encode() + key


def perm_heads(keys: Sequence[bytes | None], perms: Sequence[int], step: int = 512) -> Iterator[tuple[slice, np.ndarray]]:
    """The leading 64 bits of md5(perm ':' id), a row an id and a column a
    permutation, for ``step`` ids at a time; they order like the hex digits."""
    starts = [b"%d:" % p for p in perms]
    for a in range(0, len(keys), step):
        some = keys[a:a + step]
        digests = b"".join([hashlib.md5(s + (k or b""), usedforsecurity=False).digest() for k in some for s in starts])
        yield slice(a, a + len(some)), np.frombuffer(digests, ">u8").reshape(len(some), len(starts), 2)[:, :, 0]


def permutation_cuts(rows: DataFrame, n_perms: int, reach: float = 12.0) -> list[str]:
    """Per permutation the (md5, id) key, as one string, of the last row that
    gets label 1: as many rows of least md5(perm ':' id) as carry label 1.

    Hashes are uniform, so that row lies within a few standard deviations
    (``reach``) of its share of the hash range.  In one pass the rows under this
    window are counted, a number per task and permutation, and only those inside,
    the square root of all, are ranked; a window that missed is widened.
    ``n_perms`` strings come back.  Ids may be of any type."""
    n, known, n1 = rows.agg(F.count("*"), F.count("id"), F.coalesce(F.sum("y"), F.lit(0))).first()
    n1 -= n - known  # rows without id come first, and carry no label
    cuts = [""] * n_perms  # no label 1: nothing is at or under ""
    todo = list(range(n_perms)) if 0 < n1 <= known else []
    if not todo:
        return cuts
    keys = spread(rows.filter(F.col("id").isNotNull()), "id").select(_id_bytes("id").alias("id"))
    share, top = n1 / known, (1 << 64) - 1
    while todo:
        half = reach * (np.sqrt(share * (1 - share) / known) + 1 / known)
        low, high = int(max(0.0, share - half) * top), min(int((share + half) * top), top)
        counted = keys.mapInArrow(_near(todo, low, high), "perm int, key binary, c long") \
            .groupBy("perm", "key").agg(F.sum("c").alias("c"))
        upto = Window.partitionBy("perm").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)  # NULL, the rows under it, first
        found = counted.withColumn("upto", F.sum("c").over(upto)) \
            .filter(F.col("key").isNotNull() & (F.col("upto") >= n1) & (F.col("upto") - F.col("c") < n1)) \
            .select("perm", F.col("key").cast("string").alias("key")).collect()  # a row per permutation
        for r in found:
            cuts[r["perm"]] = r["key"]
        if low == 0 and high == top:
            break
        todo = sorted(set(todo) - {r["perm"] for r in found})
        reach *= 16
    return cuts


def _near(perms: list[int], low: int, high: int):
    """Of ids' hashes in ``perms``: how many lie under ``low`` (key NULL), and the keys from there up to ``high``."""
    schema = pa.schema([("perm", pa.int32()), ("key", pa.binary()), ("c", pa.int64())])

    def near(batches):
        under = np.zeros(len(perms), np.int64)
        for batch in batches:
            ids = batch["id"].to_pylist()
            for at, heads in perm_heads(ids, perms):
                under += (heads < low).sum(axis=0)
                row, col = np.nonzero((heads >= low) & (heads <= high))
                which = [perms[j] for j in col]
                yield pa.RecordBatch.from_arrays([
                    pa.array(which, pa.int32()),
                    pa.array([_full_key(p, ids[at.start + i]) for p, i in zip(which, row)], pa.binary()),
                    pa.array(np.ones(len(which), np.int64))], schema=schema)
        yield pa.RecordBatch.from_arrays([pa.array(perms, pa.int32()), pa.nulls(len(perms), pa.binary()), pa.array(under)], schema=schema)

    return near


def permuted_labels(rows: DataFrame, n_perms: int, id_col: str = "id",
                    label_col: str = "y") -> DataFrame:
    """(perm, id, y): in permutation ``perm`` the rows of least md5(perm ':' id)
    have label 1, as many as really do.  Labels are computed row by row from
    the permutations' cut keys: no join and no order of the ids."""
    base = rows.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
    labels = label_vector(permutation_cuts(base, n_perms), "id")
    return base.select("id", F.posexplode(labels).alias("perm", "label")) \
        .select("perm", F.col("id").alias(id_col), F.col("label").alias("y"))


def label_vector(cuts: list[str], id_col: str) -> "F.Column":
    """Array of a row's labels (0 or 1) in every permutation."""
    known = F.array(*[F.lit(c) for c in cuts])
    return F.transform(known, lambda cut, perm: F.when(
        F.concat(_perm_key(perm, id_col), F.col(id_col).cast("string")) <= cut, 1).otherwise(0))


def mi_permutation(long: DataFrame, n_perms: int = 100, bins: int = 10,
                   quantile: float = 0.95, estimator: str = "binned",
                   k: int = 5) -> DataFrame:
    """Per feature: real binned MI, the ``quantile`` of its permutation null,
    and the empirical p-value ``(#{null >= real} + 1) / (P + 1)``.

    All (perm, feature) MI values come from one grouped job: a row's bins meet
    its label vector once, and only (perm, feature, bin, label) cells, combined
    map-side, are shuffled."""
    rows = long.select("id", "y").distinct()
    if estimator == "knn":
        null = mi_knn_permuted(long, n_perms, k)
        real = mi_knn(long, k)
    elif estimator == "binned":
        cuts = permutation_cuts(rows, n_perms)
        per_id = rank_bins(long, bins).groupBy("id").agg(F.collect_list(F.struct("feature", "bin")).alias("bins"))
        cells = per_id.select("bins", F.posexplode(label_vector(cuts, "id")).alias("perm", "y")) \
            .select("perm", "y", F.explode("bins").alias("b")).select("perm", "y", "b.*")
        counts = cells.groupBy("perm", "feature", "bin", "y").agg(F.count(F.lit(1)).alias("c"))
        null = mi_from_counts(counts, ["perm", "feature"])
        real = mi_binned(long, bins)
    else:
        raise ValueError(estimator)
    null = null.withColumn("mi", F.round("mi", 12))
    real = real.withColumn("mi", F.round("mi", 12))
    j = null.withColumnRenamed("mi", "null_mi").join(real, "feature")
    return j.groupBy("feature").agg(
        F.first("mi").alias("mi"),
        F.percentile(F.col("null_mi"), quantile).alias("null_q"),
        ((F.count_if(F.col("null_mi") >= F.col("mi")) + 1) / F.lit(n_perms + 1.0)).alias("p_value"))


# ---------------------------------------------------------------- correlation
def rank_wide(long: DataFrame, features: Sequence[str], materialize: bool = True) -> DataFrame:
    """(id, y, <feature>...: average ranks, __label: rank of y) — one row per id.

    Several actions read this table (moments, residual ranks, correlations),
    so by default it is written once to the checkpoint directory."""
    rr = row_ranks(long)
    wide = rr.groupBy("id", "y").pivot("feature", list(features)).agg(F.first("rank"))
    ylong = long.select("id", "y").distinct().withColumn("feature", F.lit("__label")) \
        .withColumn("x", F.col("y").cast("double"))
    yr = row_ranks(ylong).select("id", F.col("rank").alias("__label"))
    out = wide.join(yr, "id")
    return cut_lineage(out) if materialize else out


def spearman_pairs(wide_ranks: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature_a, feature_b, rho) for a < b in list order: Pearson of average
    ranks over the rows that have all of them, from one covariance matrix
    summed up from Gram blocks.  A constant feature has rho NULL."""
    fs = list(features)
    vectors = wide_ranks.dropna(subset=fs).select(F.array(*[F.col(f"`{f}`") for f in fs]).alias("v"))
    cov = cut_lineage(covariance_matrix(vectors, "v"))
    var = cov.filter("i = j").select(F.col("i").alias("k"), F.col("cov").alias("var"))
    names = F.array(*[F.lit(f) for f in fs])
    rho = F.try_divide("cov", F.sqrt(F.col("va") * F.col("vb")))
    return cov.filter("i < j").join(var.select(F.col("k").alias("i"), F.col("var").alias("va")), "i") \
        .join(var.select(F.col("k").alias("j"), F.col("var").alias("vb")), "j") \
        .select(F.get(names, F.col("i")).alias("feature_a"), F.get(names, F.col("j")).alias("feature_b"),
                rho.alias("rho"))


def _pearson(a: str, b: str) -> "F.Column":
    """Correlation, NULL where one side is constant."""
    return F.try_divide(F.covar_pop(a, b), F.sqrt(F.var_pop(F.when(F.col(b).isNotNull(), F.col(a)))
                                                  * F.var_pop(F.when(F.col(a).isNotNull(), F.col(b)))))


def point_biserial_top(long: DataFrame, top_n: int) -> DataFrame:
    """Top-N features by |corr(y, x)|, constant features skipped; ties by name."""
    per = long.groupBy("feature").agg(_pearson("x", "y").alias("r"))
    return (per.where(F.col("r").isNotNull())
            .select("feature", F.abs("r").alias("abs_r"))
            .orderBy(F.desc("abs_r"), F.asc("feature")).limit(top_n))


def partial_spearman(wide_ranks: DataFrame, tests: Sequence[tuple[str, Sequence[str]]],
                     label: str = "__label") -> DataFrame:
    """For each (feature, controls): regress the ranks of feature and label on
    the ranks of the controls (least squares from ``covar_pop``), rank the
    residuals (rounded to 9 places so float noise does not break ties) and
    correlate them.  Returns (feature, controls, n, rho, t_stat, p_value); a
    residual without spread has rho and t_stat NULL and p-value 1, a perfect
    one t_stat NULL and p-value 0.

    One aggregation pass gives every moment of every test (a handful of
    numbers); residuals of all tests are ranked together (partitioned by test)
    and correlated in one grouped pass."""
    tests = [(f, list(c)) for f, c in tests]
    cols = sorted({x for f, c in tests for x in (f, label, *c)})
    pairs = sorted({tuple(sorted((t, c))) for f, cs in tests for t in (f, label) for c in cs}
                   | {tuple(sorted((a, b))) for f, cs in tests for a in cs for b in cs})
    aggs = [F.avg(c).alias(f"m|{c}") for c in cols]
    aggs += [F.covar_pop(a, b).alias(f"c|{a}|{b}") for a, b in pairs]
    mom = wide_ranks.agg(*aggs).first().asDict()  # one row of moments

    def cov(a, b):
        a, b = sorted((a, b))
        return mom[f"c|{a}|{b}"]

    def resid(t, cs):
        # pseudo-inverse: constant or collinear controls explain nothing more
        gram = np.array([[cov(a, b) for b in cs] for a in cs])
        beta = np.linalg.pinv(gram, rcond=1e-10, hermitian=True) @ np.array([cov(t, c) for c in cs])
        fitted = F.lit(float(mom[f"m|{t}"] - sum(b * mom[f"m|{c}"] for b, c in zip(beta, cs))))
        for b, c in zip(beta, cs):
            fitted = fitted + F.lit(float(b)) * F.col(c)
        return F.col(t) - fitted

    rcols = []
    for i, (f, cs) in enumerate(tests):
        rcols.append(F.round(resid(f, cs), 9).alias(f"{i}|x"))
        rcols.append(F.round(resid(label, cs), 9).alias(f"{i}|y"))
    res = wide_ranks.select("id", *rcols)
    long = res.unpivot(["id"], [f"{i}|{k}" for i in range(len(tests)) for k in "xy"],
                       "feature", "x").withColumn("y", F.lit(0))
    rr = row_ranks(long).select(
        "id", F.split("feature", r"\|").getItem(0).cast("int").alias("test"),
        F.split("feature", r"\|").getItem(1).alias("kind"), "rank")
    paired = rr.groupBy("test", "id").agg(
        F.max(F.when(F.col("kind") == "x", F.col("rank"))).alias("rx"),
        F.max(F.when(F.col("kind") == "y", F.col("rank"))).alias("ry"))
    stat = paired.groupBy("test").agg(_pearson("rx", "ry").alias("rho"),
                                      F.count(F.lit(1)).alias("n"))
    names = F.create_map(*[x for i, (f, cs) in enumerate(tests)
                           for x in (F.lit(i), F.lit(f))])
    ctrl = F.create_map(*[x for i, (f, cs) in enumerate(tests)
                          for x in (F.lit(i), F.lit(",".join(cs)))])
    out = stat.select(names[F.col("test")].alias("feature"), ctrl[F.col("test")].alias("controls"),
                      "n", "rho")
    left = F.greatest(1 - F.col("rho") * F.col("rho"), F.lit(0.0))
    t = F.when(left > 0, F.col("rho") * F.sqrt(F.try_divide(F.col("n") - 2, left)))
    p = student_t_two_sided(F.col("t_stat"), (F.col("n") - 2).cast("double"))
    return out.withColumn("t_stat", t).withColumn(
        "p_value", F.when(F.col("rho").isNull() | (F.col("n") < 3), 1.0).when(F.col("t_stat").isNull(), 0.0).otherwise(p))


def conflicts(wide_ranks: DataFrame, features: Sequence[str], threshold: float = 0.85) -> list[tuple[str, str]]:
    """Pairs of features with |Spearman| over ``threshold``; the rest of the
    matrix stays in Spark."""
    over = spearman_pairs(wide_ranks, features).filter(F.abs("rho") > threshold)
    return [(r["feature_a"], r["feature_b"]) for r in over.collect()]


def redundancy_prune(candidates: Sequence[str], pairs: Sequence[tuple[str, str]], mi: dict[str, float]) -> list[str]:
    """Features left when every conflicting pair, in candidate order, loses its
    member of lower MI (of equal MI the later one) unless one is gone already."""
    place = {f: i for i, f in enumerate(candidates)}
    edges = sorted(tuple(sorted((place[a], place[b]))) for a, b in pairs if a in place and b in place)
    alive = set(place.values())
    for edge in edges:
        if alive.issuperset(edge):
            alive.remove(min(edge, key=lambda i: (mi.get(candidates[i], 0.0), -i)))
    return [f for f in candidates if place[f] in alive]


# ------------------------------------------------------- covariance and PCA
def covariance_matrix(df: DataFrame, vec_col: str) -> DataFrame:
    """Sample covariance (i, j, cov) for i <= j of an array column, two-pass:
    per-dimension means first (d numbers), then each partition folds its
    centred rows into a d x d Gram block with numpy; blocks are summed by a
    grouped aggregation.  Work is distributed; only d means reach the driver."""
    means = (df.select(F.posexplode(vec_col).alias("i", "v")).groupBy("i")
             .agg(F.avg(F.col("v").cast("double")).alias("m")).collect())
    d = len(means)
    mean_vec = np.zeros(d)
    for r in means:
        mean_vec[r["i"]] = r["m"]
    iu = np.triu_indices(d)

    def gram(batches):
        acc = np.zeros((d, d))
        n = 0
        for pdf in batches:
            if len(pdf) == 0:
                continue
            x = np.stack(pdf[vec_col].to_numpy()).astype(np.float64) - mean_vec
            acc += x.T @ x
            n += len(x)
        if n:
            yield pd.DataFrame({"i": iu[0].astype("int32"), "j": iu[1].astype("int32"),
                                "s": acc[iu], "n": np.full(len(iu[0]), n, dtype="int64")})

    blocks = df.select(vec_col).mapInPandas(gram, "i int, j int, s double, n long")
    return blocks.groupBy("i", "j").agg((F.sum("s") / (F.sum("n") - 1)).alias("cov"))


def pca_scores(df: DataFrame, id_col: str, vec_col: str, k: int = 30,
               prefix: str = "pc_"):
    """Mean-centred PCA (Spark ML's PCA does not centre, so a StandardScaler
    with mean and without scaling goes first).  Returns (scores, PipelineModel);
    the explained variance ratios are ``model.stages[-1].explainedVariance``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, StandardScaler
    from pyspark.ml.functions import array_to_vector, vector_to_array

    vec = df.select(id_col, array_to_vector(F.col(vec_col).cast("array<double>")).alias("__v"))
    pipe = Pipeline(stages=[StandardScaler(inputCol="__v", outputCol="__c", withMean=True,
                                           withStd=False),
                            PCA(k=k, inputCol="__c", outputCol="__p")])
    model = pipe.fit(vec)
    arr = vector_to_array(F.col("__p"))
    scores = model.transform(vec).select(id_col, *[arr[i].alias(f"{prefix}{i}") for i in range(k)])
    return scores, model


# ------------------------------------------------------------ kNN estimator
def hash_uniform(*cols) -> "F.Column":
    """Deterministic pseudo-uniform in [-0.5, 0.5) from md5 of the columns."""
    h = F.md5(F.concat_ws(":", *[F.col(c).cast("string") for c in cols]))
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long").cast("double") / F.lit(float(1 << 52)) - F.lit(0.5)


HEAVY = 64  # values that may have sub-buckets of their own, per feature
CLUMP_BUCKETS = 1024


def value_scale(long: DataFrame, jitter: float) -> DataFrame:
    """(feature, sd, jit, edges): population std (1 where it is 0), the width of
    the jitter around every scaled value, and the ends of that stretch around
    values that many rows share (at most ``HEAVY`` a feature, from a mergeable
    frequent-items sketch).  Written, as the sketch may differ when made again."""
    per_f = long.groupBy("feature").agg(
        F.stddev_pop("x").alias("sd"), F.avg(F.abs("x")).alias("mabs"), F.count("x").alias("n"),
        F.expr(f"approx_top_k(x, {HEAVY}, {64 * HEAVY})").alias("top"))
    sd = F.when(F.col("sd") > 0, F.col("sd")).otherwise(F.lit(1.0))
    jit = F.lit(jitter) * F.greatest(F.lit(1.0), F.col("mabs") / sd)
    heavy = F.filter("top", lambda t: (t["count"] > 1) & (t["count"] * F.lit(4 * HEAVY) >= F.col("n")) & t["item"].isNotNull())
    per_f = per_f.select("feature", sd.alias("sd"), jit.alias("jit"), heavy.alias("heavy"))
    edges = F.flatten(F.transform("heavy", lambda t: F.array(
        t["item"] / F.col("sd") - F.col("jit") / 2, t["item"] / F.col("sd") + F.col("jit") / 2)))
    return cut_lineage(per_f.select("feature", "sd", "jit", F.array_sort(edges).alias("edges")))


def jittered(long: DataFrame, per_f: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``cols``, the scaled and jittered value v, and its feature's edges and jit."""
    return long.join(F.broadcast(per_f), "feature").select(  # a row per feature
        *cols, (F.col("x") / F.col("sd") + F.col("jit") * hash_uniform("feature", "id")).alias("v"), "edges", "jit")


def clump_bucket(v: "F.Column") -> "F.Column":
    """Sub-bucket of a jittered value, not decreasing in it: the log bucket, the
    number of edges of clumps up to the value, and in which of the jitter's
    ``CLUMP_BUCKETS`` parts behind the last edge it lies.  So the rows of one
    much repeated value spread over as many buckets, by their jitter."""
    below = F.when(F.size("edges") == 0, 0).otherwise(F.size(F.filter("edges", lambda e: e <= v)))
    part = F.floor((v - F.get("edges", below - 1)) / F.col("jit") * CLUMP_BUCKETS)
    return F.struct(log_bucket(v).alias("b"), below.alias("e"), F.least(F.coalesce(part, F.lit(0)), F.lit(
        CLUMP_BUCKETS)).cast("int").alias("c"))


def mi_knn(long: DataFrame, k: int = 5, jitter: float = 1e-10,
           keys: Sequence[str] = ("feature",), scale_from: DataFrame | None = None,
           block_rows: int = 4096) -> DataFrame:
    """Per feature: kNN mutual information between a continuous x and a
    discrete label (Ross 2014), the estimator behind the reference's MI.

    x is scaled by its population std and jittered by a deterministic hash
    (``jitter * max(1, mean|x|) * u``) to break ties.  Classes with a single
    row are dropped; each class uses ``k_c = min(k, n_c - 1)``.

    * radius: within (keys, class), exact row numbers (bounded prefix sums);
      rows are cut into blocks of ``block_rows`` consecutive row numbers and
      the 2k neighbouring values come from ``lag``/``lead`` inside a block;
      the few rows within k of a block edge get theirs from an equi join on
      (keys, class, row number + offset) — never all pairs.  The k-th
      neighbour distance is the narrowest window of k_c + 1 consecutive
      values holding the row.
    * m_i: points of any class strictly inside the radius, from one ordered
      sweep over the points and the two bounds of every row (bounded prefix
      sums again); the radius is shrunk by 1e-12 relative so the k-th
      neighbour itself is excluded.
    * MI = psi(n) + mean psi(k_c) - mean psi(n_c) - mean psi(m), floored at 0.

    ``keys`` groups the estimate (default per feature; ``("perm", "feature")``
    for permuted labels).  Scaling and jitter depend on (feature, id) only;
    ``scale_from`` supplies the unreplicated long table for the scaling
    statistics (default: ``long`` itself).
    """
    K = list(keys)
    per_f = value_scale(long if scale_from is None else scale_from, jitter)
    pts = jittered(long, per_f, K + ["id", "y"])
    cls = pts.groupBy(*K, "y").agg(F.count(F.lit(1)).alias("nc"))
    pts = (pts.join(cls, [*K, "y"]).where(F.col("nc") > 1)
           .withColumn("kc", F.least(F.lit(k), F.col("nc") - 1)))

    bucket = clump_bucket(F.col("v"))
    ranked = sorted_prefix(pts, [*K, "y"], "v", {"r": F.lit(1)}, tie_cols=["id"], bucket=bucket)
    # written, as are the radii: neighbours, bounds and counts read them many times over, and the
    # plan that repeats what is before them at each outgrows the driver
    ranked = cut_lineage(ranked.select(*K, "y", "id", "v", "kc", "nc", "r"))
    offs = [d for d in range(-k, k + 1) if d != 0]
    B = max(block_rows, 2 * k + 1)
    blk = F.floor(F.col("r") / F.lit(B))
    ranked = ranked.withColumn("__blk", blk).withColumn("__pos", F.col("r") - blk * F.lit(B))
    inside = Window.partitionBy(*K, "y", "__blk").orderBy("r")
    base_cols = [*K, "y", "id", "v", "kc", "nc"]
    win = ranked.select(*base_cols, "__pos", *[
        (F.lag("v", -d) if d < 0 else F.lead("v", d)).over(inside).alias(str(d)) for d in offs])
    edge = (F.col("__pos") < k) | (F.col("__pos") >= B - k)
    near = (F.col("__pos") < 2 * k) | (F.col("__pos") >= B - 2 * k)
    ask = (ranked.where(edge)
           .select(*base_cols, F.explode(F.array(*[F.lit(d) for d in offs])).alias("d"), "r")
           .withColumn("rr", F.col("r") + F.col("d")))
    have = ranked.where(near).select(*K, "y", F.col("r").alias("rr"), F.col("v").alias("vn"))
    fixed = (ask.join(have, [*K, "y", "rr"], "left")
             .groupBy(*base_cols).pivot("d", offs).agg(F.first("vn")))
    nb = win.where(~edge).drop("__pos").unionByName(fixed)

    def at(d):
        return F.col("v") if d == 0 else F.col(str(d))

    def radius_for(kk):
        terms = []
        for j in range(kk + 1):
            lo, hi = at(-j), at(kk - j)
            terms.append(F.when(lo.isNotNull() & hi.isNotNull(),
                                F.greatest(F.col("v") - lo, hi - F.col("v"))))
        return F.least(*terms) if len(terms) > 1 else terms[0]

    rad = F.lit(None).cast("double")
    for kk in range(k, 0, -1):
        rad = F.when(F.col("kc") == kk, radius_for(kk)).otherwise(rad)
    withr = cut_lineage(nb.select(*K, "id", "v", "kc", "nc", (rad * F.lit(1.0 - 1e-12)).alias("rad")))

    events = (ranked.select(*K, "id", F.col("v").alias("val"), F.lit(1).alias("kind"),
                         F.lit(1).alias("w"))
              .unionByName(withr.select(*K, "id", (F.col("v") + F.col("rad")).alias("val"),
                                        F.lit(0).alias("kind"), F.lit(0).alias("w")))
              .unionByName(withr.select(*K, "id", (F.col("v") - F.col("rad")).alias("val"),
                                        F.lit(2).alias("kind"), F.lit(0).alias("w"))))
    events = events.join(F.broadcast(per_f.select("feature", "edges", "jit")), "feature")  # a row per feature
    swept = sorted_prefix(events, K, "val", {"before": "w"}, tie_cols=["kind", "id"], bucket=clump_bucket(F.col("val")))
    bounds = swept.where(F.col("kind") != 1).groupBy(*K, "id").agg(
        # a radius of 0 (more ties than the jitter tells apart) counts the ties
        F.abs(F.max(F.when(F.col("kind") == 0, F.col("before")))
              - F.max(F.when(F.col("kind") == 2, F.col("before")))).alias("m"))
    per_row = withr.join(bounds, [*K, "id"]).select(
        *K, F.col("kc").cast("double").alias("kc"), F.col("nc").cast("double").alias("nc"),
        F.greatest(F.col("m"), F.lit(1)).cast("double").alias("m"))
    agg = per_row.groupBy(*K).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.avg(digamma(F.col("kc"))).alias("pk"),
        F.avg(digamma(F.col("nc"))).alias("pn"), F.avg(digamma(F.col("m"))).alias("pm"))
    return agg.select(*K, F.greatest(
        F.lit(0.0), digamma(F.col("n")) + F.col("pk") - F.col("pn") - F.col("pm")).alias("mi"))


CHUNK_ROWS = 1 << 16  # consecutive rows of a feature's order that one task gets for all permutations
HALO = 4  # times the rows in which k neighbours of the rarer class are expected, on either side


def permuted_bits(rows: DataFrame, cuts: list[str]) -> DataFrame:
    """(id, bits): a row's labels in every permutation (:func:`label_vector`), one bit each."""
    last = [c.encode() for c in cuts]
    heads_of_last = np.array([int(c[:16] or "0", 16) for c in cuts], np.uint64)

    def pack(batches):
        for batch in batches:
            keys = batch["key"].to_pylist()
            labels = np.zeros((len(keys), len(last)), bool)
            for at, heads in perm_heads(keys, range(len(last))):
                labels[at] = heads < heads_of_last
                for i, p in zip(*np.nonzero(heads == heads_of_last)):  # the row at the cut, as a rule
                    key = keys[at.start + i]
                    labels[at.start + i, p] = key is not None and _full_key(p, key) <= last[p]
            labels[[i for i, key in enumerate(keys) if key is None]] = False
            bits = np.packbits(labels, axis=1)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array([b.tobytes() for b in bits], pa.binary())], ["id", "bits"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", _id_bytes("id").alias("key")).mapInArrow(pack, f"id {id_type}, bits binary")


def neighbour_counts(v: np.ndarray, labels: np.ndarray, own: slice, k: int, first: bool, last: bool) -> tuple[np.ndarray, int]:
    """Of the rows ``own`` of sorted values with 0/1 labels: per row the points
    inside the distance of its k-th neighbour in its class, 0 where the values
    at hand do not hold it for sure; and the number of those.  ``first`` and
    ``last`` tell that nothing precedes or follows the values."""
    m = np.zeros(len(v), np.int64)
    for c in (0, 1):
        at = np.flatnonzero(labels == c)
        x = v[at]
        lo, hi = np.searchsorted(at, [own.start, own.stop])
        i = np.arange(lo, hi)
        known = ((i >= k) | first) & ((i + k < len(x)) | last)
        best = np.full(len(i), np.inf)
        for j in range(k + 1):  # j of the k neighbours lie below
            a, b = i - j, i - j + k
            some = np.flatnonzero((a >= 0) & (b < len(x)))
            best[some] = np.minimum(best[some], np.maximum(x[i[some]] - x[a[some]], x[b[some]] - x[i[some]]))
        known &= np.isfinite(best)
        some, radius = x[i[known]], best[known] * (1.0 - 1e-12)
        inside = np.searchsorted(v, some + radius, "left") - np.searchsorted(v, some - radius, "right")
        m[at[i[known]]] = np.maximum(np.abs(inside), 1)
    return m[own], int((m[own] == 0).sum())


def mi_knn_permuted(long: DataFrame, n_perms: int, k: int = 5, jitter: float = 1e-10,
                    chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(perm, feature, mi): :func:`mi_knn` under every permutation of the labels.

    A feature's values are the same in all of them, so they are ordered once:
    rows get exact ranks, are cut into chunks of ``chunk_rows`` consecutive ones,
    and carry one bit per permutation.  A chunk comes with as many rows of its
    neighbours as hold k rows of either class many times over; one task counts
    the neighbours of all permutations in it.  What is shuffled does not depend
    on their number, but for a bit per row and a cell per (feature, permutation, chunk).

    Where the rows at hand do not hold a neighbour (a rarer class than one row in about
    ``chunk_rows / HALO / (k + 16)``), or a class has k rows or fewer, the permutations
    concerned take :func:`mi_knn` on replicated rows: the same estimate."""
    spark = long.sparkSession
    rows = cut_lineage(long.select("id", "y").distinct())
    cuts = permutation_cuts(rows, n_perms)
    size = long.groupBy("feature").agg(
        F.count("x").alias("n"), F.sum("y").alias("n1"), F.count_if(F.col("x").isNull()).alias("missing")).collect()

    def replicated(perms: list[int]) -> DataFrame:
        labels = label_vector(cuts, "id")
        labels = rows.select("id", F.posexplode(labels).alias("perm", "y")).filter(F.col("perm").isin(perms))
        return mi_knn(long.drop("y").join(labels, "id"), k, jitter, keys=("perm", "feature"), scale_from=long)

    rarer = min((min(r["n1"], r["n"] - r["n1"]) / max(r["n"], 1) for r in size), default=0.0)
    if not size or any(r["missing"] or min(r["n1"], r["n"] - r["n1"]) <= k for r in size):
        return replicated(list(range(n_perms)))
    halo = min(int(np.ceil(HALO * (k + 16) / rarer)), chunk_rows)
    totals = {r["feature"]: (r["n"], r["n1"]) for r in size}  # a row per feature

    pts = jittered(long, value_scale(long, jitter), ["feature", "id"])
    ranked = sorted_prefix(pts, ["feature"], "v", {"r": F.lit(1)}, tie_cols=["id"], bucket=clump_bucket(F.col("v")))
    chunk, at = F.floor(F.col("r") / chunk_rows), F.col("r") % chunk_rows
    chunks = F.filter(F.array(chunk, F.when(at < halo, chunk - 1), F.when(at >= chunk_rows - halo, chunk + 1)),
                      lambda c: c.isNotNull() & (c >= 0))
    dealt = ranked.join(permuted_bits(spread(rows, "id"), cuts), "id").select("feature", F.explode(chunks).alias("chunk"), "r", "v", "bits")
    upto = 1 << 12
    psi = np.concatenate([[0.0, -np.euler_gamma], -np.euler_gamma + np.cumsum(1.0 / np.arange(1, upto))])

    def digammas(m: np.ndarray) -> np.ndarray:
        big = np.maximum(m, upto).astype(np.float64)  # beyond the table the series is exact to the last digits
        return np.where(m < upto, psi[np.minimum(m, upto - 1)], np.log(big) - 0.5 / big - 1 / (12 * big * big))

    def count(key, table):
        feature, c = key[0].as_py(), key[1].as_py()
        r = table["r"].to_numpy()
        order = np.argsort(r)
        r, v = r[order], table["v"].to_numpy()[order]
        bits = np.frombuffer(b"".join(table["bits"].to_pylist()), np.uint8).reshape(len(r), -1)[order]
        labels = np.unpackbits(bits, axis=1, count=n_perms)
        own = slice(*np.searchsorted(r, [c * chunk_rows, (c + 1) * chunk_rows]).tolist())
        first, last = r[0] == 0, r[-1] == totals[feature][0] - 1
        sums, unsure = np.zeros(n_perms), np.zeros(n_perms, np.int64)
        if own.stop > own.start:  # the chunk behind the last one may hold others' rows only
            for p in range(n_perms):
                m, unsure[p] = neighbour_counts(v, labels[:, p], own, k, first, last)
                sums[p] = digammas(m[m > 0]).sum()
        return pa.table({"feature": [feature] * n_perms, "perm": pa.array(range(n_perms), pa.int32()),
                         "psi": sums, "unsure": unsure})

    cells = spread(dealt, "feature", "chunk").groupBy("feature", "chunk").applyInArrow(count, "feature string, perm int, psi double, unsure long") \
        .groupBy("feature", "perm").agg(F.sum("psi").alias("psi"), F.sum("unsure").alias("unsure"))
    cells = cut_lineage(cells)  # a row per feature and permutation
    again = sorted(r[0] for r in cells.filter("unsure > 0").select("perm").distinct().collect())
    whole = spark.createDataFrame([(f, float(n), float(n1)) for f, (n, n1) in totals.items()], "feature string, n double, n1 double")
    n, n1, n0 = F.col("n"), F.col("n1"), F.col("n") - F.col("n1")
    mi = digamma(n) + digamma(F.lit(float(k))) - (n1 * digamma(n1) + n0 * digamma(n0)) / n - F.col("psi") / n
    out = cells.filter(~F.col("perm").isin(again)) if again else cells
    out = out.join(F.broadcast(whole), "feature").select("perm", "feature", F.greatest(F.lit(0.0), mi).alias("mi"))
    return out.unionByName(replicated(again)) if again else out


# ------------------------------------------------------------ orchestration
REPORT_SCHEMA = ("feature string, mw_effect double, mw_p_adj double, mi double, "
                 "mi_null_q double, mi_p_adj double, passed_tests int, partial_drop int, "
                 "redundant_drop int, selected int")


def screen(long: DataFrame, features: Sequence[str],
           partial_tests: Sequence[tuple[str, Sequence[str]]] = (), n_perms: int = 100,
           estimator: str = "knn", k: int = 5, bins: int = 10, mw_alpha: float = 0.05,
           mi_alpha: float = 0.1, partial_alpha: float = 0.05,
           corr_threshold: float = 0.85) -> DataFrame:
    """The four screening stages on the long form, one report row per feature:

    1. Mann-Whitney U + BH at ``mw_alpha``; 2. permutation MI + BH at
    ``mi_alpha`` (a feature must pass both); 3. partial Spearman of each
    interaction test whose feature and controls all passed (drop at
    p >= ``partial_alpha``); 4. greedy redundancy walk over |Spearman| >
    ``corr_threshold``, dropping the lower-MI feature (the later on ties).

    Statistics are distributed jobs; only per-feature and per-pair rows reach
    the driver for the greedy walk."""
    spark = long.sparkSession
    mw = bh_adjust(mann_whitney(long), "p_value", "mw_p_adj", alpha=mw_alpha,
                   reject_col="mw_reject")
    mp = bh_adjust(mi_permutation(long, n_perms, bins, estimator=estimator, k=k),
                   "p_value", "mi_p_adj", alpha=mi_alpha, reject_col="mi_reject")
    # one row per feature from either, in jobs of their own
    first = {r["feature"]: r.asDict() for r in mw.select("feature", "effect", "mw_p_adj", "mw_reject").collect()}
    second = mp.select("feature", "mi", "null_q", "mi_p_adj", "mi_reject").collect()
    gates = {r["feature"]: first[r["feature"]] | r.asDict() for r in second if r["feature"] in first}
    candidates = [f for f in features if f in gates and gates[f]["mw_reject"]
                  and gates[f]["mi_reject"]]
    tests = [(f, list(c)) for f, c in partial_tests
             if f in candidates and all(x in candidates for x in c)]
    drops: set[str] = set()
    ranks = rank_wide(long, list(features)) if (tests or len(candidates) > 1) else None
    if tests:
        ps = partial_spearman(ranks, tests).collect()
        drops = {r["feature"] for r in ps if r["p_value"] is None or r["p_value"] >= partial_alpha}
    remaining = [c for c in candidates if c not in drops]
    kept = remaining
    if len(remaining) > 1:
        kept = redundancy_prune(remaining, conflicts(ranks, remaining, corr_threshold),
                                {f: gates[f]["mi"] for f in remaining})

    def num(v):
        return None if v is None else float(v)

    rows = [(f, num(gates[f]["effect"]), num(gates[f]["mw_p_adj"]), num(gates[f]["mi"]),
             num(gates[f]["null_q"]), num(gates[f]["mi_p_adj"]), int(f in candidates),
             int(f in drops), int(f in remaining and f not in kept), int(f in kept))
            for f in features if f in gates]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def screen_in_folds(long: DataFrame, folds: DataFrame, **kw) -> DataFrame:
    """Selection *inside* cross-validation: for each fold f, :func:`screen`
    on the rows of the other folds only, so a fold's labels never influence
    the features chosen for scoring it.  ``folds`` is (id, fold); returns the
    per-fold reports with a ``fold`` column (k screening runs, k bounded)."""
    fold_ids = sorted(r[0] for r in folds.select("fold").distinct().collect())
    out = None
    for f in fold_ids:
        train_ids = folds.where(F.col("fold") != f).select("id")
        rep = screen(long.join(train_ids, "id", "left_semi"), **kw) \
            .withColumn("fold", F.lit(int(f)))
        out = rep if out is None else out.unionByName(rep)
    return out
