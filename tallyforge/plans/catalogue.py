"""Query catalogue: every operator and report run on the driver tables.

``QUERIES[key] = (build, oracle_sql)``.  ``build(spark, sf_dir)`` returns a
lazy DataFrame over the whole driver tables (re-aimed through
``sources.driver_views`` where a report needs the fortress schema);
``oracle_sql`` is the naive form of the same query for DuckDB, or None
where only row counts can be compared.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..sources.driver_views import V1, V2, build_views, views_sql
from ..sources.tables import load

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, tuple[Builder, str | None]] = {}
# oracle SQL text -> the body written against the report tables (without
# the driver re-aiming prefix), so the same naive SQL runs on fixtures
BODIES: dict[str, str] = {}
SCHEMA_OF: dict[str, str] = {}   # oracle SQL text -> "v1" / "v2"


def register(key: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = (fn, sql)
        return fn
    return deco


# ``source`` is a directory of driver parquet tables, or -- for tests -- a
# mapping of already built tables in the report schema.

def driver(spark: SparkSession, source) -> Mapping[str, DataFrame]:
    if isinstance(source, Mapping):
        return source
    return load(spark, source)


def v1(spark: SparkSession, source) -> Mapping[str, DataFrame]:
    if isinstance(source, Mapping):
        return source
    return build_views(driver(spark, source), V1)


def v2(spark: SparkSession, source, names) -> Mapping[str, DataFrame]:
    if isinstance(source, Mapping):
        return {n: source[n] for n in names}
    return build_views(driver(spark, source), V2, names)


def _with(specs, names: str, body: str) -> str:
    sql = views_sql(specs, names.split()) + "\n" + body
    BODIES[sql] = "WITH " + body.lstrip()[1:] if body.lstrip().startswith(",") else body
    SCHEMA_OF[sql] = "v1" if specs is V1 else "v2"
    return sql


def with_v1(names: str, body: str) -> str:
    return _with(V1, names, body)


def with_v2(names: str, body: str) -> str:
    return _with(V2, names, body)


# importing the sections registers their keys
from . import catalogue_aggs, catalogue_basic, catalogue_long, catalogue_reports  # noqa: E402,F401
