"""Reports on seeded random fixtures in their own schemas: the Spark plans
(factorised fan-outs, as-of extremes, substring join, zero covariance)
against the naive SQL of the same report run by DuckDB on identical
parquet input."""

import tempfile

import duckdb
import pytest

from .compare import compare
from tallyforge.plans.catalogue import BODIES, QUERIES, SCHEMA_OF

from .fixtures import materialise, v1_tables, v2_tables

SEEDS = [3, 11, 29]
V1_KEYS = [k for k, (_, sql) in QUERIES.items() if SCHEMA_OF.get(sql) == "v1"]
V2_KEYS = [k for k, (_, sql) in QUERIES.items() if SCHEMA_OF.get(sql) == "v2"]


def _run(spark, tables, keys):
    con = duckdb.connect()
    out = tempfile.mkdtemp(prefix="tf-fixture-")
    dfs = materialise(spark, con, tables, out)
    bad = []
    for k in keys:
        fn, sql = QUERIES[k]
        res = compare(spark, con, k, fn, BODIES[sql], dfs)
        if res["status"] != "ok":
            bad.append(res)
    return bad


@pytest.mark.parametrize("seed", SEEDS)
def test_v1_reports_on_fixtures(spark, seed):
    assert V1_KEYS
    assert _run(spark, v1_tables(seed), V1_KEYS) == []


@pytest.mark.parametrize("seed", SEEDS)
def test_v2_reports_on_fixtures(spark, seed):
    assert len(V2_KEYS) >= 20
    assert _run(spark, v2_tables(seed), V2_KEYS) == []
