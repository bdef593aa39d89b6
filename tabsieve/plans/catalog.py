"""Registry: query key -> (callable(spark, sf_dir) -> DataFrame, oracle SQL or None).

A ``None`` oracle marks a query that SQL cannot express (model fits, pandas-UDF
text folding, iterative estimators); those are checked by brute force in tests.
"""

from __future__ import annotations

import importlib

MODULES = ["encoding", "cleaning", "enrichment", "joining", "screening", "text",
           "modelling", "compositions", "experiments"]


def registry() -> dict:
    out: dict = {}
    for m in MODULES:
        mod = importlib.import_module(f"{__package__}.{m}")
        out.update(mod.QUERIES)
    return out


def queries() -> dict:
    return {k: v[0] for k, v in registry().items()}


def oracle_sql() -> dict:
    return {k: v[1] for k, v in registry().items() if v[1] is not None}
