"""Catalogue keys for sources, predicates, joins and the v1 reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import trunc_avg
from ..functions.scalar import recent
from . import basic
from .catalogue import driver, register, v1, with_v1

AS_OF = "2024-01-30 00:00:00"   # fixed instant replacing GETDATE()


@register("scan_all", "SELECT * FROM lineitem")
def scan_all(spark, d):
    return driver(spark, d)["lineitem"].select("*")


@register("inner_join", with_v1(
    "Dwarves Squads",
    """SELECT d.dwarf_id, d.name AS dwarf_name, d.age, d.profession, s.squad_id,
              s.name AS squad_name, s.mission
       FROM Dwarves d JOIN Squads s ON d.squad_id = s.squad_id"""))
def inner_join(spark, d):
    return basic.dwarves_with_squads(v1(spark, d))


@register("anti_join_null_check", with_v1(
    "Dwarves Squads",
    """SELECT * FROM Dwarves WHERE profession = 'BUILDING'
       AND (squad_id IS NULL OR squad_id NOT IN (SELECT squad_id FROM Squads WHERE squad_id IS NOT NULL))"""))
def anti_join_null_check(spark, d):
    return basic.without_squad(v1(spark, d), profession="BUILDING")


@register("filter_and", with_v1(
    "Tasks", "SELECT * FROM Tasks WHERE status = 'F' AND priority = '1-URGENT'"))
def filter_and(spark, d):
    return basic.tasks_with(v1(spark, d), status="F", priority="1-URGENT")


@register("filter_range_eq", with_v1(
    "Dwarves", """SELECT dwarf_id, name, age, profession FROM Dwarves
                  WHERE age > 5000 AND profession = 'MACHINERY'"""))
def filter_range_eq(spark, d):
    return basic.older_of_profession(v1(spark, d), min_age=5000, profession="MACHINERY")


@register("filter_in", """SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
                          WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""")
def filter_in(spark, d):
    return (driver(spark, d)["orders"].where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
            .select("o_orderkey", "o_custkey", "o_orderpriority"))


@register("filter_or", """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
                          WHERE o_orderstatus = 'P' OR o_totalprice > 400000""")
def filter_or(spark, d):
    return (driver(spark, d)["orders"]
            .where((F.col("o_orderstatus") == "P") | (F.col("o_totalprice") > 400000))
            .select("o_orderkey", "o_orderstatus", "o_totalprice"))


@register("predicate_eq_null", with_v1(
    "Squads", "SELECT (leader_id = NULL) IS NULL AS unknown, COUNT(*) AS squads FROM Squads GROUP BY 1"))
def predicate_eq_null(spark, d):
    """``= NULL`` is unknown for every row: counted, not folded away."""
    unknown = (F.col("leader_id") == F.lit(None)).isNull()
    return v1(spark, d)["Squads"].groupBy(unknown.alias("unknown")).agg(F.count(F.lit(1)).alias("squads"))


@register("predicate_is_null", with_v1("Squads", "SELECT squad_id, name FROM Squads WHERE leader_id IS NULL"))
def predicate_is_null(spark, d):
    return basic.squads_without_leader(v1(spark, d))


@register("recent_window", f"""SELECT event_id, user_id, ts FROM events
    WHERE ts > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""")
def recent_window(spark, d):
    e = driver(spark, d)["events"]
    return e.where(recent("ts", AS_OF, 7)).select("event_id", "user_id", "ts")


@register("group_count", with_v1(
    "Dwarves Items",
    """SELECT d.dwarf_id, d.name, COUNT(i.item_id) AS item_count
       FROM Dwarves d JOIN Items i ON d.dwarf_id = i.owner_id GROUP BY d.dwarf_id, d.name"""))
def group_count(spark, d):
    return basic.item_count_by_owner(v1(spark, d))


@register("left_group_null_bucket", with_v1(
    "Dwarves Squads",
    """, heads AS (SELECT squad_id AS sid, COUNT(dwarf_id) AS n FROM Dwarves GROUP BY 1),
       placed AS (SELECT Squads.squad_id, Squads.name, n FROM heads LEFT OUTER JOIN Squads ON sid = Squads.squad_id)
       SELECT IFNULL(squad_id, -1) AS squad_id, IFNULL(name, 'No Squad') AS squad_name, CAST(SUM(n) AS BIGINT) AS dwarf_count
       FROM placed GROUP BY placed.squad_id, placed.name"""))
def left_group_null_bucket(spark, d):
    return basic.dwarves_per_squad(v1(spark, d))


@register("in_group_sort_desc", with_v1(
    "Dwarves Tasks",
    """, pending AS (SELECT assigned_to, COUNT(task_id) AS n FROM Tasks WHERE status = 'O' OR status = 'P' GROUP BY ALL)
       SELECT profession, CAST(SUM(n) AS BIGINT) AS unfinished_tasks FROM pending, Dwarves
       WHERE dwarf_id = assigned_to GROUP BY profession"""))
def in_group_sort_desc(spark, d):
    return basic.unfinished_by_profession(v1(spark, d), statuses=("O", "P"))


@register("join_average", with_v1(
    "Dwarves Items",
    """SELECT i.type, round(AVG(d.age), 6) AS avg_age
       FROM Items i JOIN Dwarves d ON i.owner_id = d.dwarf_id GROUP BY i.type"""))
def join_average(spark, d):
    return basic.avg_age_by_item_type(v1(spark, d)).withColumn("avg_age", F.round("avg_age", 6))


@register("trunc_average", """SELECT p_type, CAST(SUM(p_size) // COUNT(p_size) AS BIGINT) AS avg_size
                              FROM part GROUP BY p_type""")
def trunc_average(spark, d):
    return driver(spark, d)["part"].groupBy("p_type").agg(trunc_avg("p_size").alias("avg_size"))


@register("having_scalar_subquery", with_v1(
    "Dwarves Items",
    """, mean AS (SELECT CAST(SUM(age) AS DOUBLE) / COUNT(age) AS m FROM Dwarves),
       owners AS (SELECT DISTINCT owner_id FROM Items WHERE item_id IS NOT NULL AND owner_id IS NOT NULL)
       SELECT dwarf_id, name FROM (SELECT DISTINCT dwarf_id, name, age FROM Dwarves), mean
       WHERE age > m AND (dwarf_id IS NULL OR dwarf_id NOT IN (SELECT owner_id FROM owners))"""))
def having_scalar_subquery(spark, d):
    return basic.older_than_average_without_items(v1(spark, d))


@register("inner_join_dups", with_v1(
    "Dwarves Items",
    """SELECT d.dwarf_id, d.name, d.age, d.profession FROM Dwarves d
       JOIN Items i ON i.owner_id = d.dwarf_id WHERE i.type = 'F'"""))
def inner_join_dups(spark, d):
    return basic.owners_of_type(v1(spark, d), item_type="F")


@register("semi_join", with_v1(
    "Dwarves Items",
    """SELECT d.dwarf_id, d.name, d.age, d.profession FROM Dwarves d
       WHERE EXISTS (SELECT 1 FROM Items i WHERE i.owner_id = d.dwarf_id AND i.type = 'F')"""))
def semi_join(spark, d):
    return basic.owners_of_type(v1(spark, d), item_type="F", distinct=True)


@register("left_group_two_keys", with_v1(
    "Dwarves Tasks",
    """, load AS (SELECT assigned_to AS who, status AS st, COUNT(task_id) AS n FROM Tasks GROUP BY ALL)
       SELECT dwarf_id, name, IFNULL(st, '-') AS status, CAST(IFNULL(SUM(n), 0) AS BIGINT) AS task_count
       FROM Dwarves LEFT OUTER JOIN load ON who = dwarf_id GROUP BY dwarf_id, name, st"""))
def left_group_two_keys(spark, d):
    return basic.tasks_by_status(v1(spark, d))


@register("three_way_join", with_v1(
    "Tasks Dwarves Squads",
    """SELECT t.* FROM Tasks t JOIN Dwarves d ON t.assigned_to = d.dwarf_id
       JOIN Squads s ON s.squad_id = d.squad_id WHERE s.name = 'NATION_7'"""))
def three_way_join(spark, d):
    return basic.tasks_of_squad(v1(spark, d), squad_name="NATION_7")


@register("edge_both_ways", with_v1(
    "Dwarves Relationships",
    """, ends AS (SELECT relationship, unnest([dwarf_id, related_to]) AS x, unnest([related_to, dwarf_id]) AS y FROM Relationships)
       SELECT one.name, relationship, other.name AS related_name FROM ends, Dwarves one, Dwarves other
       WHERE one.dwarf_id = x AND other.dwarf_id = y"""))
def edge_both_ways(spark, d):
    return basic.relationships_both_ways(v1(spark, d))
