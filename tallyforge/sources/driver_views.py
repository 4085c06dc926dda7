"""Re-aim the driver's TPC-H-like tables at the report schemas.

The reports are written against two fortress schemas (v1: dirs 1-2 of
the scripts; v2: dirs 3-8).  No such data ships, so every report table is
*derived* from the driver tables by a projection, a filter or a join; the
work of every report therefore grows with the driver data.

Each view is declared once as (base table, joins, filter, select list) in
portable SQL expressions.  ``build_views`` turns a spec into a lazy
DataFrame (Catalyst prunes the unused columns and pushes the filters into
the parquet scans); ``views_sql`` renders the same spec as SQL CTEs so an
independent engine can run the naive form of a report on identical input.

Mapping (fixed values): person = customer, squad = nation, task / item /
expedition / caravan = orders, product line / transaction / member =
lineitem, product = part, workshop / station / structure = supplier,
skill log / training / attack / sighting = events.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ViewSpec(NamedTuple):
    base: str
    cols: tuple[str, ...]
    joins: tuple[tuple[str, str], ...] = ()
    where: str | None = None


_SUPPLIER_REGION = (("nation", "s_nationkey = n_nationkey"), ("region", "n_regionkey = r_regionkey"))
_BY_CUSTOMER_ORDERS = (("customer", "o_custkey = c_custkey"),)
_BY_CUSTOMER_EVENTS = (("customer", "user_id = c_custkey"),)
_LINE_ORDERS = (("orders", "l_orderkey = o_orderkey"),)

# v1 (dirs 1-2).  All tables are taken whole; null and dangling
# keys come from expressions over the keys.
V1: dict[str, ViewSpec] = {
    "Dwarves": ViewSpec("customer", (
        "c_custkey AS dwarf_id", "c_name AS name", "c_acctbal AS age",
        "c_mktsegment AS profession",
        "CAST(CASE c_nationkey % 5 WHEN 0 THEN NULL WHEN 1 THEN c_nationkey + 100 ELSE c_nationkey END AS BIGINT) AS squad_id")),
    "Squads": ViewSpec("nation", (
        "CAST(n_nationkey AS BIGINT) AS squad_id", "n_name AS name", "r_name AS mission",
        "CASE WHEN n_regionkey = 0 THEN NULL ELSE CAST(n_nationkey AS BIGINT) END AS leader_id"),
        joins=(("region", "n_regionkey = r_regionkey"),)),
    "Tasks": ViewSpec("orders", (
        "o_orderkey AS task_id", "o_orderstatus AS status", "o_orderpriority AS priority",
        "o_custkey AS assigned_to")),
    "Items": ViewSpec("orders", (
        "o_orderkey AS item_id", "o_orderstatus AS type",
        "CASE o_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN -o_custkey ELSE o_custkey END AS owner_id")),
    "Relationships": ViewSpec("lineitem", (
        "o_custkey AS dwarf_id", "l_suppkey AS related_to", "l_returnflag AS relationship"),
        joins=_LINE_ORDERS),
}

# v2 (dirs 3-8).
V2: dict[str, ViewSpec] = {
    "FORTRESSES": ViewSpec("nation", (
        "CAST(n_nationkey AS BIGINT) AS fortress_id", "n_name AS name",
        "CASE WHEN n_regionkey < 4 THEN r_name END AS location",
        "CAST(1000 + n_nationkey AS INT) AS founded_year",
        "CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE CAST(n_nationkey * 10 AS INT) END AS depth",
        "CAST(n_regionkey AS INT) AS population"),
        joins=(("region", "n_regionkey = r_regionkey"),)),
    "DWARVES": ViewSpec("customer", (
        "c_custkey AS dwarf_id", "c_name AS name", "CAST(floor(c_acctbal / 100) AS INT) AS age",
        "c_mktsegment AS profession", "CAST(c_nationkey AS BIGINT) AS fortress_id")),
    "FORTRESS_RESOURCES": ViewSpec("part", (
        "CAST(p_size AS BIGINT) AS fortress_id", "p_partkey AS resource_id")),
    "WORKSHOPS": ViewSpec("supplier", (
        "s_suppkey AS workshop_id", "s_name AS name", "r_name AS type",
        "CAST(floor(abs(s_acctbal) / 2000) AS INT) AS quality",
        "CAST(s_nationkey AS BIGINT) AS fortress_id"), joins=_SUPPLIER_REGION),
    "MILITARY_SQUADS": ViewSpec("nation", (
        "CAST(n_nationkey AS BIGINT) AS squad_id", "n_name AS name",
        "CAST(n_regionkey AS STRING) AS formation_type",
        "CASE WHEN n_regionkey = 0 THEN NULL ELSE CAST(n_nationkey AS BIGINT) END AS leader_id",
        "CAST(n_nationkey AS BIGINT) AS fortress_id")),
    "DWARF_SKILLS": ViewSpec("events", (
        "user_id AS dwarf_id", "event_id AS skill_id",
        "DATE '1995-01-01' + CAST(floor(value * 5) AS INT) AS date",
        "CAST(floor(value) AS INT) AS experience", "CAST(floor(value / 50) AS INT) AS level",
        "CASE WHEN event_type IN ('click', 'purchase') THEN 'Combat' ELSE event_type END AS skill_type")),
    "DWARF_ASSIGNMENTS": ViewSpec("orders", ("o_orderkey AS assignment_id", "o_custkey AS dwarf_id")),
    "SQUAD_MEMBERS": ViewSpec("customer", (
        "CAST(c_nationkey AS BIGINT) AS squad_id", "c_custkey AS dwarf_id",
        "CASE WHEN c_acctbal < 0 THEN DATE '2000-01-01' END AS exit_date")),
    "DWARF_EQUIPMENT": ViewSpec("lineitem", ("l_partkey AS equipment_id", "o_custkey AS dwarf_id"),
                                joins=_LINE_ORDERS),
    "WORKSHOP_CRAFTSDWARVES": ViewSpec("lineitem", ("l_suppkey AS workshop_id", "o_custkey AS dwarf_id"),
                                       joins=_LINE_ORDERS),
    "PROJECTS": ViewSpec("lineitem", ("l_orderkey AS project_id", "l_suppkey AS workshop_id")),
    "WORKSHOP_MATERIALS": ViewSpec("lineitem", (
        "l_suppkey AS workshop_id", "l_partkey AS material_id",
        "CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS is_input",
        "CAST(floor(l_quantity) AS INT) AS quantity")),
    "WORKSHOP_PRODUCTS": ViewSpec("lineitem", (
        "l_suppkey AS workshop_id", "l_partkey AS product_id", "l_shipdate AS production_date",
        "CAST(floor(l_quantity) AS INT) AS quantity")),
    "PRODUCTS": ViewSpec("part", (
        "p_partkey AS product_id", "CAST(p_retailprice AS DECIMAL(18,2)) AS value",
        "p_size AS quality", "p_type AS type")),
    "SQUAD_EQUIPMENT": ViewSpec("supplier", ("CAST(s_nationkey AS BIGINT) AS squad_id", "s_suppkey AS equipment_id")),
    "EQUIPMENT": ViewSpec("supplier", (
        "s_suppkey AS equipment_id", "CAST(floor(abs(s_acctbal) / 2000) AS INT) AS quality")),
    "SQUAD_OPERATIONS": ViewSpec("orders", ("CAST(c_nationkey AS BIGINT) AS squad_id", "o_orderkey AS operation_id"),
                                 joins=_BY_CUSTOMER_ORDERS),
    "SQUAD_TRAINING": ViewSpec("events", (
        "CAST(c_nationkey AS BIGINT) AS squad_id", "event_id AS schedule_id",
        "value / 500.0 AS effectiveness"), joins=_BY_CUSTOMER_EVENTS),
    "SQUAD_BATTLES": ViewSpec("orders", (
        "CAST(c_nationkey AS BIGINT) AS squad_id", "o_orderkey AS report_id",
        "CASE WHEN o_orderstatus = 'F' THEN 'Victory' WHEN o_orderstatus = 'O' THEN 'Repelled' "
        "WHEN o_orderpriority = '2-HIGH' THEN 'Partial Breach' ELSE 'Defeat' END AS outcome",
        "CAST(floor(o_totalprice / 100000) AS INT) AS casualties",
        "CAST(floor(o_totalprice / 25000) AS INT) % 7 AS enemy_casualties",
        "CAST(o_orderdate AS DATE) AS date"), joins=_BY_CUSTOMER_ORDERS),
    "EXPEDITIONS": ViewSpec("orders", (
        "o_orderkey AS expedition_id", "o_orderpriority AS destination",
        "CASE WHEN o_orderstatus = 'F' THEN 'Completed' ELSE 'Open' END AS status",
        "CAST(o_orderdate AS DATE) AS departure_date",
        "CASE WHEN o_orderstatus = 'P' THEN NULL "
        "ELSE CAST(o_orderdate AS DATE) + CAST(floor(o_totalprice / 10000) AS INT) END AS return_date")),
    "EXPEDITION_MEMBERS": ViewSpec("lineitem", (
        "l_orderkey AS expedition_id", "l_suppkey AS dwarf_id",
        "CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS survived")),
    "EXPEDITION_ARTIFACTS": ViewSpec("lineitem", (
        "CASE WHEN l_orderkey % 3 = 0 THEN -l_orderkey ELSE l_orderkey END AS expedition_id", "l_partkey AS artifact_id",
        "CAST(l_extendedprice AS DECIMAL(18,2)) AS value")),
    "EXPEDITION_SITES": ViewSpec("lineitem", (
        "CASE WHEN l_orderkey % 4 = 0 THEN -l_orderkey ELSE l_orderkey END AS expedition_id",
        "CAST(l_linenumber AS BIGINT) AS site_id")),
    "EXPEDITION_CREATURES": ViewSpec("lineitem", (
        "CASE WHEN l_orderkey % 5 = 0 THEN -l_orderkey ELSE l_orderkey END AS expedition_id",
        "CASE l_returnflag WHEN 'A' THEN 'Success' WHEN 'R' THEN 'Victory' ELSE 'Defeat' END AS outcome")),
    "CARAVANS": ViewSpec("orders", ("o_orderkey AS caravan_id", "o_orderpriority AS civilization_type")),
    "TRADE_TRANSACTIONS": ViewSpec("lineitem", (
        "l_orderkey AS caravan_id", "CAST(l_extendedprice AS DECIMAL(18,2)) AS value",
        "CASE l_returnflag WHEN 'A' THEN 'positive' WHEN 'R' THEN 'negative' ELSE 'neutral' END "
        "AS balance_direction", "CAST(l_shipdate AS DATE) AS date")),
    "DIPLOMATIC_EVENTS": ViewSpec("events", (
        "CAST(floor(event_id / 2) AS BIGINT) AS caravan_id",
        "CASE WHEN event_type = 'error' THEN NULL ELSE CAST(floor(value / 10) AS INT) - 20 END "
        "AS relationship_change")),
    "CARAVAN_GOODS": ViewSpec("lineitem", (
        "l_orderkey AS caravan_id",
        "CASE p_type WHEN 'ECONOMY' THEN 'Exotic Metals' WHEN 'SMALL' THEN 'Lumber' ELSE p_type END "
        "AS material_type", "CAST(floor(l_quantity) AS INT) AS quantity",
        "l_partkey AS material_id", "l_partkey AS original_product_id"),
        joins=(("part", "l_partkey = p_partkey"),)),
    "creature_attacks": ViewSpec("events", (
        "event_id AS attack_id", "user_id AS creature_id",
        "CAST(floor(value / 100) AS INT) AS casualties",
        "CASE event_type WHEN 'click' THEN 'Repelled' WHEN 'error' THEN 'Breached' ELSE event_type END "
        "AS outcome",
        "CASE WHEN event_type = 'view' THEN NULL ELSE CAST(floor(value / 20) AS INT) END AS enemy_casualties",
        "props AS defense_structures_used", "CAST(c_nationkey AS BIGINT) AS location_id",
        "DATE '2018-01-01' + CAST(floor(value * 10) AS INT) AS date"), joins=_BY_CUSTOMER_EVENTS),
    "defense_structures": ViewSpec("supplier", (
        "s_suppkey AS structure_id", "r_name AS type",
        "CAST(floor(abs(s_acctbal) / 2000) AS INT) AS quality",
        "CAST(s_nationkey AS BIGINT) AS location_id"), joins=_SUPPLIER_REGION),
    "locations": ViewSpec("nation", (
        "CAST(n_nationkey AS BIGINT) AS location_id", "n_name AS name",
        "CAST(n_regionkey AS INT) AS fortification_level",
        "CAST(length(n_name) - 7 AS INT) AS access_points")),
    "military_stations": ViewSpec("supplier", (
        "CAST(s_nationkey AS BIGINT) AS coverage_zone_id",
        "CASE WHEN s_acctbal < 0 THEN NULL ELSE CAST(floor(s_acctbal / 100) AS INT) END "
        "AS response_time_to_zone")),
    "creatures": ViewSpec("customer", (
        "c_custkey AS creature_id", "c_mktsegment AS type",
        "CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS active")),
    "creature_sightings": ViewSpec("events", (
        "event_id AS sighting_id", "user_id AS creature_id", "CAST(ts AS DATE) AS date")),
    "creature_territories": ViewSpec("orders", (
        "o_custkey AS creature_id", "CAST(substr(o_orderpriority, 1, 1) AS INT) AS danger_level",
        "o_totalprice / 1000.0 AS distance_to_fortress")),
    "military_coverage_zones": ViewSpec("supplier", (
        "CAST(s_nationkey AS BIGINT) AS squad_id", "CAST(floor(s_suppkey / 4) AS BIGINT) AS zone_id",
        "CAST(floor(abs(s_acctbal) / 100) AS INT) AS response_time_to_zone")),
}

def build_view(tables: Mapping[str, DataFrame], spec: ViewSpec) -> DataFrame:
    df = tables[spec.base]
    for name, cond in spec.joins:
        df = df.join(tables[name], F.expr(cond))
    if spec.where:
        df = df.where(F.expr(spec.where))
    return df.selectExpr(*spec.cols)


def build_views(tables: Mapping[str, DataFrame], specs: Mapping[str, ViewSpec],
                names: Iterable[str] | None = None) -> Mapping[str, DataFrame]:
    """The named views (all of ``specs`` by default), each built -- and its
    driver tables opened -- only when a report asks for it."""
    from .tables import LazyTables
    return LazyTables(list(names or specs), lambda n: build_view(tables, specs[n]))


def view_sql(spec: ViewSpec) -> str:
    sql = f"SELECT {', '.join(spec.cols)} FROM {spec.base}"
    for name, cond in spec.joins:
        sql += f" JOIN {name} ON {cond}"
    if spec.where:
        sql += f" WHERE {spec.where}"
    return sql


def views_sql(specs: Mapping[str, ViewSpec], names: Iterable[str]) -> str:
    """``WITH name AS (...), ...`` prefix defining the named views."""
    return "WITH " + ",\n".join(f"{n} AS ({view_sql(specs[n])})" for n in names)
