"""Every registered query runs; those with an oracle equal DuckDB's result
(row count, column names, order-insensitive rounded values)."""

import pytest

from tabsieve.plans import catalog
from tools.oracle_check import check

from conftest import SF_SMALL

FAST_SKIP = {"cv_summary"}  # five forest fits; covered by the benchmark and test_model


@pytest.fixture(scope="module")
def results(spark):
    keys = [k for k in catalog.queries() if k not in FAST_SKIP]
    return check(spark, SF_SMALL, keys, verbose=False)


def test_registry_consistent():
    q, o = catalog.queries(), catalog.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 52


@pytest.mark.parametrize("key", sorted(k for k in catalog.queries() if k not in FAST_SKIP))
def test_query(results, key):
    status = results[key]
    assert status[0] in ("OK", "ROWS_ONLY"), status


DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float"}


def test_oracle_column_types_match(spark):
    from tools.oracle_check import duck
    con = duck(SF_SMALL)
    bad = {}
    for key, (fn, sql) in catalog.registry().items():
        if sql is None or key == "mi_permutation_knn":  # its types equal mi_permutation's
            continue
        st = dict(fn(spark, SF_SMALL).dtypes)
        dt = {r[0]: DUCK_TO_SPARK.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
        if st != dt:
            bad[key] = (st, dt)
    assert not bad, bad
