"""Stacking: a logistic second level over base models' out-of-fold scores.

Iteratively reweighted least squares.  A round's normal equations are sums of
products over rows, aggregated by Spark per fold; totals minus a fold's sums
are the equations without that fold, so the k models that score held-out rows
and the model of all rows come out of one pass a round.  Only those sums,
(m + 1)(m + 4) / 2 numbers a fold, reach the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

RIDGE = 1e-6  # on every coefficient: keeps separable data and equal scores solvable


def _logit(cols: Sequence[str], beta: np.ndarray) -> Column:
    out = F.lit(float(beta[0]))
    for c, b in zip(cols, beta[1:]):
        out = out + F.lit(float(b)) * F.col(f"`{c}`")
    return out


def probability(cols: Sequence[str], beta: np.ndarray) -> Column:
    """1 / (1 + exp(-x b)), the exponent kept in the range of doubles."""
    z = F.greatest(F.least(_logit(cols, beta), F.lit(700.0)), F.lit(-700.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit_stack(scores: DataFrame, cols: Sequence[str], label: str = "y", fold: str = "fold",
              rounds: int = 8, tol: float = 1e-10, ridge: float = RIDGE) -> dict:
    """Coefficients (intercept first) per left-out fold and, under None, of all
    rows.  ``scores`` holds out-of-fold base scores, so no row's score comes from
    a base model that saw it.  Rows with a NULL score, label or fold do not count;
    without rows all coefficients are 0."""
    m = len(cols) + 1
    clean = scores.select(F.col(fold).alias("f"), F.col(label).cast("double").alias("y"),
                          *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(cols, 1)]).dropna()
    clean = cut_lineage(clean)  # read once a round
    xs = [F.lit(1.0)] + [F.col(f"x{i}") for i in range(1, m)]
    folds = sorted(r[0] for r in clean.select("f").distinct().collect())  # k values
    models = [None, *folds]
    beta = {f: np.zeros(m) for f in models}
    names = [f"x{i}" for i in range(1, m)]
    for _ in range(rounds if folds else 0):
        # each row serves the models that may see it: that of all rows and those of other folds
        sums = []
        for i, f in enumerate(models):
            seen = F.lit(True) if f is None else F.col("f") != F.lit(f)
            p = probability(names, beta[f])
            w, r = p * (1 - p), F.col("y") - p
            sums += [F.sum(F.when(seen, w * xs[a] * xs[b])).alias(f"h{i}_{a}_{b}") for a in range(m) for b in range(a, m)]
            sums += [F.sum(F.when(seen, r * xs[a])).alias(f"g{i}_{a}") for a in range(m)]
        row = clean.agg(*sums).first()
        moved = 0.0
        for i, f in enumerate(models):
            if row[f"g{i}_0"] is None:
                continue  # one fold only: its model has no rows
            hess = np.array([[row[f"h{i}_{min(a, b)}_{max(a, b)}"] for b in range(m)] for a in range(m)])
            grad = np.array([row[f"g{i}_{a}"] for a in range(m)])
            step = np.linalg.solve(hess + ridge * np.eye(m), grad - ridge * beta[f])
            beta[f] = beta[f] + step
            moved = max(moved, float(np.abs(step).max()))
        if moved < tol:
            break
    return beta


def stacked(scores: DataFrame, cols: Sequence[str], beta: dict, fold: str = "fold", out_col: str = "p") -> DataFrame:
    """``scores`` with the second level's probability: of the model that left the
    row's fold out, and of the model of all rows where the fold is none of them."""
    p = probability(cols, beta[None])
    for f, b in beta.items():
        if f is not None:
            p = F.when(F.col(fold) == F.lit(f), probability(cols, b)).otherwise(p)
    return scores.withColumn(out_col, p)
