"""Score arriving entity rows with a fitted smoothed encoding (stream-static
joins only; no state, so no watermark is needed)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import encode


def encode_stream(stream: DataFrame, bridge: DataFrame, scores: DataFrame, gm,
                  entity: str, person: str, out_col: str, count_col: str | None = None) -> DataFrame:
    """``stream`` of entity rows -> same rows + encoding.  ``bridge`` and
    ``scores`` are static DataFrames; the per-entity aggregate of the bridge
    is static too, so the streaming side only does a left join.  ``gm`` must
    be a literal (scalar subqueries are not allowed in streaming plans)."""
    return encode.apply_scores(stream, bridge, scores, gm, entity, person, out_col, count_col)


def fit_static(train: DataFrame, bridge: DataFrame, entity: str, person: str, label: str,
               k: float = 20.0):
    """Fit scores on a static training table; the global mean is returned as a
    literal Column (one number)."""
    scores, gm = encode.smoothed_scores(train, bridge, entity, person, label, k)
    gm_value = train.select(entity, label).join(bridge.select(entity, person), entity) \
        .agg(F.avg(F.col(label).cast("double"))).first()[0]
    return scores, F.lit(gm_value)
