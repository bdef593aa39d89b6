"""Modelling: feature-matrix assembly, a leak-free target-encoding Estimator,
fold-wise cross-validation, hyperparameter search, threshold sweep and
order-preserving predictions.

Leak-freedom by construction: :class:`SmoothedEncoder` is an ML ``Estimator``
whose ``fit`` sees only the rows it is given.  Put it first in a ``Pipeline``;
every fold of :func:`cross_validate` / ``CrossValidator`` refits it on that
fold's training rows, so validation labels never reach the encodings.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import encode

# Numeric feature names taken when present (in this order),
# followed by every genre_* and mltag_* column.
DEFAULT_NUMERIC = ["runtime", "log_votes", "film_age", "vote_density", "votes_per_minute",
                   "runtime_short", "runtime_long", "votes_x_runtime", "is_foreign",
                   "director_prestige", "writer_prestige", "n_directors", "n_writers",
                   "ml_rating_mean", "ml_rating_std", "ml_rating_count", "ml_rating_median",
                   "ml_log_count", "ml_tag_count", "tmdb_vote_avg", "tmdb_vote_count",
                   "tmdb_log_votes", "lb_rating_mean", "lb_rating_count", "lb_rating_std",
                   "lb_log_count", "bechdel_score", "bechdel_pass"]
DEFAULT_PREFIXES = ["genre_", "mltag_"]


def select_features(columns: Sequence[str], numeric: Sequence[str] = DEFAULT_NUMERIC,
                    prefixes: Sequence[str] = DEFAULT_PREFIXES,
                    selected: Sequence[str] | None = None) -> list[str]:
    """Fixed names present in ``columns`` then prefix matches, de-duplicated,
    optionally restricted to ``selected`` (kept in ``selected`` order)."""
    out: list[str] = []
    for c in [c for c in numeric if c in columns] + \
             [c for p in prefixes for c in columns if c.startswith(p)]:
        if c not in out:
            out.append(c)
    if selected is not None:
        out = [c for c in selected if c in out]
    return out


def label_index(df: DataFrame, col: str, out_col: str = "label_idx") -> DataFrame:
    """Class label -> index in *sorted* class order (0 for the alphabetically
    first), not Spark's default frequency order."""
    from pyspark.ml.feature import StringIndexer
    idx = StringIndexer(inputCol=col, outputCol=out_col, stringOrderType="alphabetAsc")
    return idx.fit(df.select(F.col(col).cast("string").alias(col))).transform(
        df.withColumn(col, F.col(col).cast("string")))


def feature_matrix(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """keys + features as DOUBLE with NULL/NaN -> 0."""
    cols = [F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")),
                       F.lit(0.0)).alias(c) for c in features]
    return df.select(*keys, *cols)


# ----------------------------------------------------------- encoder stage
class _EncoderParams(Params):
    entityCol = Param(Params._dummy(), "entityCol", "entity key", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 label", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "smoothing strength", TypeConverters.toFloat)


class SmoothedEncoder(Estimator, _EncoderParams):
    """Fits smoothed person scores from the labelled rows it is given and adds
    ``<name>`` (mean member score) and ``<count name>`` per bridge table."""

    @keyword_only
    def __init__(self, *, bridges=None, entityCol="entity", labelCol="label", k=20.0):
        super().__init__()
        self._setDefault(entityCol="entity", labelCol="label", k=20.0)
        self._bridges = list(bridges or [])  # [(bridge df, person col, out col, count col)]
        kwargs = self._input_kwargs
        kwargs.pop("bridges", None)
        self._set(**kwargs)

    def _fit(self, dataset: DataFrame) -> "SmoothedEncoderModel":
        ent, lab, k = self.getOrDefault("entityCol"), self.getOrDefault("labelCol"), self.getOrDefault("k")
        fitted = []
        for bridge, person, out_col, count_col in self._bridges:
            scores, gm = encode.smoothed_scores(dataset.select(ent, lab), bridge, ent, person, lab, k, written=True)
            fitted.append((bridge, person, out_col, count_col, scores, gm))
        return SmoothedEncoderModel(ent, fitted)

    def fold_encoded(self, dataset: DataFrame, fold_col: str, folds: Sequence) -> DataFrame:
        """``dataset`` with ``<name>__<i>`` for the i-th fold, as this encoder fitted
        on the other folds' rows adds ``<name>``, and the counts, the same for all."""
        ent, lab, k = self.getOrDefault("entityCol"), self.getOrDefault("labelCol"), self.getOrDefault("k")
        out = dataset
        for bridge, person, out_col, count_col in self._bridges:
            enc, gm = encode.fold_encodings(dataset.select(ent, lab, fold_col), bridge, ent, person, lab,
                                            fold_col, list(folds), k)
            out = out.drop(*[c for c in (out_col, count_col) if c]).join(enc, ent, "left")
            out = out.withColumns({f"{out_col}__{i}": F.coalesce(F.col(f"__e{i}"), F.lit(m).cast("double"))
                                   for i, m in enumerate(gm)})
            if count_col:
                out = out.withColumn(count_col, F.coalesce(F.col("__cnt"), F.lit(1)).cast("long"))
            out = out.drop("__cnt", *[f"__e{i}" for i in range(len(gm))])
        return out

    def names(self) -> list[str]:
        return [out_col for _, _, out_col, _ in self._bridges]


def fold_view(data: DataFrame, names: Sequence[str], i: int) -> DataFrame:
    """The i-th iteration of a table with ``<name>__<i>`` columns."""
    wide = {f"{c}__" for c in names}
    rest = [c for c in data.columns if not any(c.startswith(w) and c[len(w):].isdigit() for w in wide)]
    return data.select(*rest, *[F.col(f"{c}__{i}").alias(c) for c in names])


class SmoothedEncoderModel(Model):
    def __init__(self, entity: str, fitted):
        super().__init__()
        self._entity = entity
        self._fitted = fitted
        self._encodings = None  # every entity's, written by the first transform for all

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self._encodings is None:
            self._encodings = [cut_lineage(encode.entity_scores(bridge, scores, gm, self._entity, person))
                               for bridge, person, _, _, scores, gm in self._fitted]
        out = dataset
        for per_entity, (_, _, out_col, count_col, _, gm) in zip(self._encodings, self._fitted):
            out = encode.join_encodings(out, per_entity, gm, self._entity, out_col, count_col)
        return out


class LineageCut(Estimator):
    """Pipeline stage that, at fit time only, writes the training rows once to
    the checkpoint directory (reliable, survives executor loss), so an
    iterative learner's many passes read materialised rows instead of
    re-running joins and encodings.  The fitted stage passes scoring data
    through untouched."""

    def _fit(self, dataset: DataFrame) -> "LineageCutModel":
        return LineageCutModel(dataset, cut_lineage(dataset))


class LineageCutModel(Model):
    def __init__(self, source: DataFrame | None = None, materialised: DataFrame | None = None):
        super().__init__()
        self._source, self._materialised = source, materialised

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # Pipeline.fit hands the very same DataFrame to the fitted stage
        if self._source is not None and dataset is self._source:
            return self._materialised
        return dataset


def forest_pipeline(encoder: SmoothedEncoder | None, features: Sequence[str],
                    label: str = "y", num_trees: int = 30, max_depth: int = 8,
                    seed: int = 42, cut: bool = True) -> Pipeline:
    """``cut=False`` is for rows that are a written table already."""
    stages = [encoder] if encoder is not None else []
    stages += [VectorAssembler(inputCols=list(features), outputCol="features",
                               handleInvalid="keep"),
               *([LineageCut()] if cut else []),
               RandomForestClassifier(labelCol=label, featuresCol="features",
                                      numTrees=num_trees, maxDepth=max_depth, seed=seed)]
    return Pipeline(stages=stages)


def positive_probability(df: DataFrame, col: str = "probability") -> Column:
    return vector_to_array(F.col(col))[1]


def cross_validate(pipeline: Pipeline, data: DataFrame, fold_col: str, label: str = "y",
                   keys: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Fit on every fold's complement, score the fold.  Returns
    (per-fold accuracy table, out-of-fold scores (keys, fold, y, p)).

    A :class:`SmoothedEncoder` in first place is fitted for all folds in one
    pass over its bridges; the learner reads the one table written."""
    data = cut_lineage(data)  # k fits and k scorings read it
    stages = pipeline.getStages()
    encoder = stages[0] if stages and isinstance(stages[0], SmoothedEncoder) else None
    folds = [r[0] for r in data.select(fold_col).distinct().orderBy(fold_col).collect()]
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    accs, oof = [], None
    if encoder is not None:
        data = cut_lineage(encoder.fold_encoded(data, fold_col, folds))
        pipeline = Pipeline(stages=[s for s in stages[1:] if not isinstance(s, LineageCut)])
    for i, f in enumerate(folds):  # k is a small constant: k distributed fits, not a row loop
        rows = data if encoder is None else fold_view(data, encoder.names(), i)
        model = pipeline.fit(rows.where(F.col(fold_col) != f))
        scored = model.transform(rows.where(F.col(fold_col) == f))
        accs.append((int(f), float(evaluator.evaluate(scored))))
        part = scored.select(*keys, F.col(fold_col), F.col(label).alias("y"),
                             positive_probability(scored).alias("p"))
        oof = part if oof is None else oof.unionByName(part)
    acc = data.sparkSession.createDataFrame(accs, "fold int, accuracy double")
    return acc, oof


def cross_validate_encoded(pipeline: Pipeline, data: DataFrame, fold_col: str,
                           label: str = "y", iter_col: str = "fold_iter",
                           parallelism: int = 4, wide: Sequence[str] = ()) -> DataFrame:
    """CV over a table that already holds every iteration's leak-free
    encodings (see :func:`tabsieve.operators.encode.fold_iteration_encode`):
    iteration f trains on ``iter == f and fold != f`` and scores
    ``iter == f and fold == f``.  The table is materialised once; only the
    learner is fitted per fold, ``parallelism`` folds at a time (concurrent
    Spark jobs from driver threads, as ``CrossValidator(parallelism=...)``
    does), fewer where one fit's tasks fill the cores.  Returns the per-fold accuracy table.

    ``wide`` names encodings that are columns ``<name>__<i>`` of the i-th
    of the sorted folds, one row per labelled row, instead of rows per iteration."""
    from concurrent.futures import ThreadPoolExecutor
    data = cut_lineage(data)
    folds = [r[0] for r in data.select(fold_col).distinct().orderBy(fold_col).collect()]
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")

    cores = data.sparkSession.sparkContext.defaultParallelism
    parallelism = min(parallelism, max(1, parallelism * cores // max(data.rdd.getNumPartitions(), 1)))

    def one(f):
        it = fold_view(data, wide, folds.index(f)) if wide else data.where(F.col(iter_col) == f)
        model = pipeline.fit(it.where(F.col(fold_col) != f))
        return int(f), float(evaluator.evaluate(model.transform(it.where(F.col(fold_col) == f))))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        accs = list(pool.map(one, folds))
    return data.sparkSession.createDataFrame(accs, "fold int, accuracy double")


def cv_summary(acc: DataFrame) -> DataFrame:
    """Mean and *population* std of fold accuracies."""
    return acc.agg(F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std"),
                   F.count(F.lit(1)).alias("n_folds"))


def tune_forest(pipeline: Pipeline, data: DataFrame, fold_col: str, label: str = "y",
                grid: dict | None = None, parallelism: int = 2, num_folds: int = 5):
    """Grid search with ``CrossValidator(foldCol=...)``; the encoder stage is
    refit per fold.  Returns the fitted CrossValidatorModel."""
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    rf = pipeline.getStages()[-1]
    grid = grid or {rf.numTrees: [20, 40], rf.maxDepth: [6, 10], rf.minInstancesPerNode: [1, 3]}
    b = ParamGridBuilder()
    for p, vals in grid.items():
        b = b.addGrid(p, vals)
    cv = CrossValidator(estimator=pipeline, estimatorParamMaps=b.build(),
                        evaluator=MulticlassClassificationEvaluator(labelCol=label,
                                                                    metricName="accuracy"),
                        foldCol=fold_col, numFolds=num_folds, parallelism=parallelism)
    return cv.fit(data)


def drawn_settings(ranges: dict[str, tuple], n: int, seed: int = 42) -> list[dict]:
    """``n`` settings drawn from ``ranges`` (name -> (low, high), both included;
    whole numbers where both are) by a hash of seed, number and name: the same
    for the same arguments, whatever the order of the names."""
    out = []
    for i in range(n):
        one = {}
        for name, (low, high) in ranges.items():
            u = int(hashlib.md5(f"{seed}:{i}:{name}".encode()).hexdigest()[:13], 16) / 16.0 ** 13
            whole = isinstance(low, int) and isinstance(high, int)
            one[name] = low + int(u * (high - low + 1)) if whole else low + u * (high - low)
        out.append(one)
    return out


def search_forest(data: DataFrame, encoder: SmoothedEncoder | None, features: Sequence[str], ranges: dict[str, tuple],
                  n: int = 80, seed: int = 42, fold_col: str = "fold", label: str = "y",
                  default: dict | None = None, fit=forest_pipeline) -> dict:
    """Settings of ``fit`` sought by successive halving over the folds: all are
    scored on the first fold, the better half of the drawn ones (by mean so far,
    earlier ones first among equals) on the next, and so on; ``default`` is scored
    on every fold and stays unless a setting that came through all folds beats
    it.  Each fold's encoded tables are made once and serve all settings.

    Returns settings, accuracy (mean over folds), fits (their number) and scores
    (setting -1: default; fold, accuracy)."""
    data = cut_lineage(data)
    folds = [r[0] for r in data.select(fold_col).distinct().orderBy(fold_col).collect()]  # k values
    default = default or {"num_trees": 30, "max_depth": 8}
    settings = dict(enumerate(drawn_settings(ranges, n, seed))) | {-1: default}
    alive, scores = [-1, *range(n)], {i: [] for i in settings}
    evaluator = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    for left, f in zip(range(len(folds) - 1, -1, -1), folds):
        train, held = data.where(F.col(fold_col) != f), data.where(F.col(fold_col) == f)
        if encoder is not None:
            encoded = encoder.fit(train)
            train, held = cut_lineage(encoded.transform(train)), cut_lineage(encoded.transform(held))
        for i in alive:
            model = fit(None, features, label, **settings[i]).fit(train)
            scores[i].append((f, float(evaluator.evaluate(model.transform(held)))))
        if left:
            mean = {i: sum(a for _, a in scores[i]) / len(scores[i]) for i in alive}
            drawn = sorted((i for i in alive if i >= 0), key=lambda i: (-mean[i], i))
            alive = [-1, *sorted(drawn[:(len(drawn) + 1) // 2])]
    means = {i: sum(a for _, a in scores[i]) / max(len(scores[i]), 1) for i in alive}
    best = max(alive, key=lambda i: (means[i], -i))  # of equal ones the default, then the earlier
    return {"settings": settings[best], "accuracy": means[best], "fits": sum(map(len, scores.values())),
            "scores": [(i, f, a) for i in sorted(scores) for f, a in scores[i]]}


# ---------------------------------------------------------- threshold sweep
def threshold_sweep(scored: DataFrame, p_col: str = "p", y_col: str = "y",
                    lo: int = 30, hi: int = 70) -> DataFrame:
    """Accuracy of ``p >= t/100`` for t = lo..hi; ``is_best`` marks the lowest
    t reaching the maximum (the first strict maximum of an ascending sweep).

    Rows are not replicated per threshold: each row is counted in the bucket
    ``b = #{t : t/100 <= p}``, and accuracy(t) follows from prefix sums over the
    (hi - lo + 2) buckets."""
    p = F.col(p_col)
    f = F.floor(p * 100).cast("int")
    f = F.when(p < f / F.lit(100.0), f - 1).when(p >= (f + 1) / F.lit(100.0), f + 1).otherwise(f)
    b = F.least(F.greatest(f - F.lit(lo - 1), F.lit(0)), F.lit(hi - lo + 1))
    counts = scored.groupBy(b.alias("b")).agg(
        F.sum(F.col(y_col)).alias("pos"), F.sum(1 - F.col(y_col)).alias("neg"))
    from pyspark.sql import Window
    # all hi - lo + 2 buckets (a fixed, tiny table), equi-joined to the counts
    buckets = scored.sparkSession.range(0, hi - lo + 2).select(F.col("id").cast("int").alias("b"))
    full = buckets.join(counts, "b", "left").fillna(0, ["pos", "neg"])
    suffix = Window.orderBy("b").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    acc = full.select(
        "b", F.sum("pos").over(suffix).alias("tp"), F.sum("neg").over(suffix).alias("fp"),
        F.sum("pos").over(everything).alias("P"), F.sum("neg").over(everything).alias("N"))
    # predicted positive at t  <=>  bucket >= t - lo + 1
    res = acc.where(F.col("b") >= 1).select(
        (F.col("b") + F.lit(lo - 1)).cast("int").alias("t_pct"),
        F.try_divide(F.col("tp") + F.col("N") - F.col("fp"), F.col("P") + F.col("N")).alias("accuracy"))
    best = Window.orderBy(F.desc("accuracy"), F.asc("t_pct"))
    return res.withColumn("is_best", (F.row_number().over(best) == 1).cast("int"))


# -------------------------------------------------------- ordered predictions
def with_row_id(df: DataFrame, col: str = "row_id", files: bool = True) -> DataFrame:
    """Order-preserving id at read time: a struct of file path, block start and
    position that sorts like the files in name order and the rows inside.
    ``df`` must be the scan itself; ``files=False`` is for other sources, whose
    partition order counts."""
    at = F.monotonically_increasing_id()  # increasing inside a split, whatever splits a task is given
    if files:
        at = F.struct("_metadata.file_path", "_metadata.file_block_start", at.alias("at"))
    return df.withColumn(col, at)


def predict_in_order(order: DataFrame, features: DataFrame, key: str, model,
                     threshold: float, row_id: str = "row_id") -> DataFrame:
    """Left join features onto the ordered key list (a key without features
    gets zeros), score, and return (row_id, key, prediction 'True'/'False')
    sorted by the original order."""
    names = [c for c, t in features.dtypes if c != key and t not in ("string", "boolean")]
    j = order.select(row_id, key).join(features, key, "left").fillna(0, names)
    scored = model.transform(j)
    pred = F.when(positive_probability(scored) >= F.lit(threshold), F.lit("True")) \
        .otherwise(F.lit("False"))
    return scored.select(row_id, key, pred.alias("prediction")).orderBy(row_id)


def write_predictions(pred: DataFrame, path: str, row_id: str = "row_id") -> None:
    """One True/False per line in input order.  A global sort range-partitions
    the rows, so part files in name order concatenate to the input order; no
    single task holds all predictions."""
    pred.orderBy(row_id).select("prediction").write.mode("overwrite").text(path)


# ------------------------------------------------------------- end to end
def best_threshold(scored: DataFrame, p_col: str = "p", y_col: str = "y", lo: int = 30, hi: int = 70) -> float:
    """The lowest threshold of best accuracy of out-of-fold probabilities."""
    return threshold_sweep(scored, p_col, y_col, lo, hi).filter("is_best = 1").first()["t_pct"] / 100.0


def train(data: DataFrame, encoder: SmoothedEncoder | None, features: Sequence[str], fold_col: str = "fold",
          label: str = "y", keys: Sequence[str] = (), grid: Sequence[dict] = (), num_trees: int = 30,
          max_depth: int = 8) -> dict:
    """Cross-validate the default forest and every setting of ``grid``
    (``num_trees``, ``max_depth``); the default stays unless it is beaten.
    Sweep the threshold over the winner's out-of-fold probabilities and refit
    it on all rows.  ``features`` are the screened ones (:func:`stats.screen`).

    Returns model, threshold, settings, accuracy (mean over folds) and oof."""
    data = cut_lineage(data)
    best = None
    for settings in [{"num_trees": num_trees, "max_depth": max_depth}, *grid]:
        pipe = forest_pipeline(encoder, features, label, **settings)
        acc, oof = cross_validate(pipe, data, fold_col, label, keys)
        mean = cv_summary(acc).first()["cv_mean"]
        if best is None or mean > best["accuracy"]:
            best = {"settings": settings, "accuracy": mean, "oof": oof, "pipe": pipe}
    best["threshold"] = best_threshold(best["oof"])
    best["model"] = best.pop("pipe").fit(data)
    return best
