"""Lossless long forms of the reports' growing lists: one row for each object
or id, with its parent and, for ordered lists, its position, so that no row
grows with the data; and LAG over a result of unbounded size."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.nested import Child, ids_long
from ..operators.ordered import with_lag, with_position
from .catalogue import driver, register, v2, with_v2


def objects_long(child, parent: str, names: dict[str, str]):
    """``parent, position, names...``: the child rows of each parent in the
    order of the named columns (NULLs first)."""
    rows = child.where(F.col(parent).isNotNull()).select(F.col(parent), *[F.col(c).alias(n) for c, n in names.items()])
    return with_position(rows, list(names.values()), within=[parent]).select(parent, "position", *names.values())


def _objects_sql(table: str, parent: str, key: str, names: dict[str, str]) -> str:
    cols = ", ".join(f"{c} AS {n}" for c, n in names.items())
    order = ", ".join(f"{c} NULLS FIRST" for c in names)
    return (f"SELECT {parent} AS {key}, row_number() OVER (PARTITION BY {parent} ORDER BY {order}) AS position, {cols} "
            f"FROM {table} WHERE {parent} IS NOT NULL")


_STRUCTURE, _SQUAD = {"structure_id": "structure_id"}, {"squad_id": "squad_id", "response_time_to_zone": "response_time"}
_ZONE = {"zone_id": "zone_id", "response_time_to_zone": "response_time"}


@register("report_security_zone_structures", with_v2("defense_structures", _objects_sql("defense_structures", "location_id", "zone_id", _STRUCTURE)))
def report_security_zone_structures(spark, d):
    t = v2(spark, d, ["defense_structures"])["defense_structures"]
    return objects_long(t.withColumnRenamed("location_id", "zone_id"), "zone_id", _STRUCTURE)


@register("report_security_zone_squads", with_v2("military_coverage_zones", _objects_sql("military_coverage_zones", "zone_id", "zone_id", _SQUAD)))
def report_security_zone_squads(spark, d):
    return objects_long(v2(spark, d, ["military_coverage_zones"])["military_coverage_zones"], "zone_id", _SQUAD)


@register("report_security_response_coverage", with_v2("military_coverage_zones", _objects_sql("military_coverage_zones", "squad_id", "squad_id", _ZONE)))
def report_security_response_coverage(spark, d):
    return objects_long(v2(spark, d, ["military_coverage_zones"])["military_coverage_zones"], "squad_id", _ZONE)


@register("report_security_structure_ids", with_v2("defense_structures", _objects_sql("defense_structures", "type", "defense_type", _STRUCTURE)))
def report_security_structure_ids(spark, d):
    t = v2(spark, d, ["defense_structures"])["defense_structures"]
    return objects_long(t.withColumnRenamed("type", "defense_type"), "defense_type", _STRUCTURE)


def _ids_sql(key: str, lists) -> str:
    return " UNION ALL ".join(
        f"SELECT {key}, '{field}' AS field, CAST({i} AS VARCHAR) AS id, COUNT(*) AS occurrences FROM {table} "
        f"WHERE {key} IS NOT NULL AND {i} IS NOT NULL GROUP BY {key}, {i}" for field, table, i in lists)


_W19_IDS = [("member_ids", "EXPEDITION_MEMBERS", "dwarf_id"), ("artifact_ids", "EXPEDITION_ARTIFACTS", "artifact_id"),
            ("site_ids", "EXPEDITION_SITES", "site_id")]
_W20_IDS = [("craftsdwarf_ids", "WORKSHOP_CRAFTSDWARVES", "dwarf_id"),
            ("product_ids", "(SELECT workshop_id, product_id FROM WORKSHOP_PRODUCTS JOIN PRODUCTS USING (product_id)) p", "product_id"),
            ("material_ids", "WORKSHOP_MATERIALS", "material_id"), ("project_ids", "PROJECTS", "project_id")]
_W21_IDS = [("member_ids", "SQUAD_MEMBERS", "dwarf_id"),
            ("equipment_ids", "(SELECT squad_id, equipment_id FROM SQUAD_EQUIPMENT JOIN EQUIPMENT USING (equipment_id)) e", "equipment_id"),
            ("battle_report_ids", "SQUAD_BATTLES", "report_id"), ("training_ids", "SQUAD_TRAINING", "schedule_id")]


@register("scorecard_expedition_ids", with_v2("EXPEDITION_MEMBERS EXPEDITION_ARTIFACTS EXPEDITION_SITES", _ids_sql("expedition_id", _W19_IDS)))
def scorecard_expedition_ids(spark, d):
    t = v2(spark, d, [x[1] for x in _W19_IDS])
    return ids_long("expedition_id", {f: Child(t[n], "expedition_id", i) for f, n, i in _W19_IDS})


@register("efficiency_workshop_ids", with_v2("WORKSHOP_CRAFTSDWARVES WORKSHOP_PRODUCTS PRODUCTS WORKSHOP_MATERIALS PROJECTS",
                                             _ids_sql("workshop_id", _W20_IDS)))
def efficiency_workshop_ids(spark, d):
    t = dict(v2(spark, d, ["WORKSHOP_CRAFTSDWARVES", "WORKSHOP_PRODUCTS", "PRODUCTS", "WORKSHOP_MATERIALS", "PROJECTS"]))
    t[_W20_IDS[1][1]] = t["WORKSHOP_PRODUCTS"].join(t["PRODUCTS"].select("product_id"), "product_id")
    return ids_long("workshop_id", {f: Child(t[n], "workshop_id", i) for f, n, i in _W20_IDS})


@register("effectiveness_squad_ids", with_v2("SQUAD_MEMBERS SQUAD_EQUIPMENT EQUIPMENT SQUAD_BATTLES SQUAD_TRAINING", _ids_sql("squad_id", _W21_IDS)))
def effectiveness_squad_ids(spark, d):
    t = dict(v2(spark, d, ["SQUAD_MEMBERS", "SQUAD_EQUIPMENT", "EQUIPMENT", "SQUAD_BATTLES", "SQUAD_TRAINING"]))
    t[_W21_IDS[1][1]] = t["SQUAD_EQUIPMENT"].join(t["EQUIPMENT"].select("equipment_id"), "equipment_id")
    return ids_long("squad_id", {f: Child(t[n], "squad_id", i) for f, n, i in _W21_IDS})


@register("report_trade_resource_ids", with_v2("CARAVAN_GOODS CARAVANS", """SELECT material_type, 'resource_ids' AS field,
    CAST(material_id AS VARCHAR) AS id, COUNT(*) AS occurrences FROM CARAVAN_GOODS JOIN CARAVANS USING (caravan_id)
    WHERE material_type IS NOT NULL AND material_id IS NOT NULL GROUP BY material_type, material_id"""))
def report_trade_resource_ids(spark, d):
    t = v2(spark, d, ["CARAVAN_GOODS", "CARAVANS"])
    goods = t["CARAVAN_GOODS"].join(t["CARAVANS"].select("caravan_id"), "caravan_id")
    return ids_long("material_type", {"resource_ids": Child(goods, "material_type", "material_id")})


@register("lag_over_rows", """SELECT o_orderkey, o_orderdate, o_totalprice,
    LAG(o_totalprice) OVER (ORDER BY o_orderdate, o_orderkey) AS previous_price FROM orders""")
def lag_over_rows(spark, d):
    """LAG over a result that grows with the data, in no single partition."""
    o = driver(spark, d)["orders"].select("o_orderkey", "o_orderdate", "o_totalprice")
    return with_lag(o, ["o_orderdate", "o_orderkey"], "o_totalprice", "previous_price")


@register("position_over_rows", """SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS position,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS own_position FROM orders""")
def position_over_rows(spark, d):
    """Places in an order of the whole result and within each customer."""
    o = driver(spark, d)["orders"].select("o_custkey", "o_orderkey", "o_totalprice")
    o = with_position(o, ["-o_totalprice", "o_orderkey"])
    o = with_position(o, ["-o_totalprice", "o_orderkey"], within=["o_custkey"], out="own_position")
    return o.select("o_custkey", "o_orderkey", "position", "own_position")
