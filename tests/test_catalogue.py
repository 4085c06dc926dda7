"""Every catalogue key against its DuckDB oracle on the driver tables (sf0.001)."""

import pytest

from .compare import compare, duck_connect
from tallyforge.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, con, key):
    fn, sql = QUERIES[key]
    res = compare(spark, con, key, fn, sql, SF)
    assert res["status"] in ("ok", "rows-only"), res
    if sql is None:
        assert res["spark_rows"] >= 0
