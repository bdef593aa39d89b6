"""Non-negative factorisation of a matrix of row vectors, V ~ W H.

Multiplicative updates: every round, each row's W is scaled towards its own
V row under the current H, and H then from the sums W'V (k x d) and W'W (k x k).
The sums are Gram blocks, one per task and summed cell by cell; so a round
shuffles k * (d + k) cells a task and no row, and the driver holds H (k x d).
W is a column next to V in a table written once a round to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

TINY = 1e-12  # keeps denominators off zero


def first_components(k: int, d: int) -> np.ndarray:
    """A start that needs no random numbers: all positive, no two rows alike."""
    c, j = np.ogrid[1:k + 1, 1:d + 1]
    return 0.5 + (c * c + c * j) % 7 / 7.0


def _matrix(column: pa.ChunkedArray, d: int) -> np.ndarray:
    """Rows of a list column as doubles; negative, missing and NaN entries count as 0, short rows are filled with 0."""
    out = np.zeros((len(column), d))
    for i, x in enumerate(column.to_pylist()):
        if x:
            out[i, :len(x)] = [0.0 if v is None else v for v in x]
    return np.maximum(np.nan_to_num(out, nan=0.0), 0.0)


def nmf(df: DataFrame, id_col: str, vec_col: str, k: int, rounds: int = 20) -> tuple[DataFrame, np.ndarray, list[float]]:
    """(rows (id, w: array of k weights), H (k x d), squared loss after every round).

    The loss never rises.  Vectors shorter than the longest are filled with 0;
    NULL, NaN and negative entries count as 0; a NULL vector is all 0 and gets
    weights near 0; rows with the same id are rows of their own; an empty table
    gives no rows, an H of no columns and no losses."""
    base = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    d = base.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    id_type = base.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, v array<double>, w array<double>"
    state = base.withColumn("w", F.array(*[F.lit(1.0)] * k))
    if d <= 0:
        return state.select("id", "w"), np.zeros((k, 0)), []
    h = first_components(k, d)
    losses = []
    for _ in range(rounds):
        gram = h @ h.T

        def scale(batches: Iterator[pa.RecordBatch], h=h, gram=gram) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                v, w = _matrix(batch["v"], d), _matrix(batch["w"], k)
                w *= v @ h.T / (w @ gram + TINY)
                yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(list(w), pa.list_(pa.float64()))],
                                                 ["id", "v", "w"])

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((k + 1, d + k))
            for batch in batches:
                v, w = _matrix(batch["v"], d), _matrix(batch["w"], k)
                sums[:k, :d] += w.T @ v
                sums[:k, d:] += w.T @ w
                sums[k, 0] += (v * v).sum()
            i, j = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                              pa.array(sums[i, j])], ["i", "j", "s"])

        state = cut_lineage(state.mapInArrow(scale, schema))
        cells = state.select("v", "w").mapInArrow(blocks, "i int, j int, s double").groupBy("i", "j").agg(
            F.sum("s").alias("s")).toArrow()  # (k + 1) * (d + k) cells at most
        sums = np.zeros((k + 1, d + k))
        sums[cells["i"].to_numpy(), cells["j"].to_numpy()] = cells["s"].to_numpy()
        wv, ww = sums[:k, :d], sums[:k, d:]
        h = h * wv / (ww @ h + TINY)
        losses.append(float(sums[k, 0] - 2 * (wv * h).sum() + (ww * (h @ h.T)).sum()))
    return state.select("id", "w"), h, losses
