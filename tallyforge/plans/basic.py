"""Flat reports on the v1 schema (Dwarves, Squads, Tasks, Items,
Relationships): joins, filters, grouped counts, HAVING, UNION ALL.

Defaults of the literal parameters are the values the scripts use.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import ifnull
from ..operators import anti, edge_both_ways, semi

Tables = Mapping[str, DataFrame]


def dwarves_with_squads(t: Tables) -> DataFrame:
    """Inner join person -> squad; persons without a squad drop out."""
    d, s = t["Dwarves"].alias("d"), t["Squads"].alias("s")
    return d.join(s, F.col("d.squad_id") == F.col("s.squad_id")).select(
        F.col("d.dwarf_id"), F.col("d.name").alias("dwarf_name"), F.col("d.age"),
        F.col("d.profession"), F.col("s.squad_id"), F.col("s.name").alias("squad_name"),
        F.col("s.mission"))


def without_squad(t: Tables, profession: str = "miner") -> DataFrame:
    """Persons of a profession whose squad key is NULL or dangles.

    The text's ``LEFT JOIN ... WHERE s.squad_id IS NULL`` is a left-anti
    join; the profession filter is applied before it (and reaches the scan).
    """
    d = t["Dwarves"].where(F.col("profession") == profession)
    s = t["Squads"].select("squad_id")
    return anti(d, s, "squad_id")


def tasks_with(t: Tables, status: str = "pending", priority=3) -> DataFrame:
    """Conjunctive filter, whole rows."""
    return t["Tasks"].where((F.col("status") == status) & (F.col("priority") == priority))


def item_count_by_owner(t: Tables) -> DataFrame:
    """Owners with at least one item and their count.

    Items are counted per owner key first (partial aggregate, one shuffle
    of the small (key, count) rows), then joined to the persons: the same
    rows as join-then-group, without carrying names through the shuffle.
    """
    counts = (t["Items"].where(F.col("owner_id").isNotNull())
              .groupBy(F.col("owner_id").alias("dwarf_id"))
              .agg(F.count("item_id").alias("item_count")))
    return t["Dwarves"].select("dwarf_id", "name").join(counts, "dwarf_id")


def dwarves_per_squad(t: Tables, none_id: int = -1, none_name: str = "No Squad") -> DataFrame:
    """Persons per squad; unmatched persons in one relabelled bucket.

    Grouping is on the squad side's (nullable) columns after the left
    join, so every person without a matching squad -- NULL or dangling key
    -- lands in the single ``none_id``/``none_name`` bucket.  Persons are
    counted per squad key before the join (map-side partial count); the
    join then meets one row per key.
    """
    per_key = (t["Dwarves"].groupBy("squad_id")
               .agg(F.count("dwarf_id").alias("n")))
    s = t["Squads"].select(F.col("squad_id").alias("s_id"), F.col("name").alias("s_name"))
    joined = per_key.join(s, per_key["squad_id"] == s["s_id"], "left")
    return (joined.groupBy("s_id", "s_name").agg(F.sum("n").alias("dwarf_count"))
            .select(ifnull("s_id", none_id).alias("squad_id"),
                    ifnull("s_name", none_name).alias("squad_name"),
                    F.col("dwarf_count")))


def unfinished_by_profession(t: Tables, statuses: Sequence[str] = ("pending", "in_progress")) -> DataFrame:
    """Tasks in a status set, counted per assignee profession, desc."""
    tasks = t["Tasks"].where(F.col("status").isin(list(statuses))).select("task_id", "assigned_to")
    d = t["Dwarves"].select("dwarf_id", "profession")
    return (tasks.join(d, tasks["assigned_to"] == d["dwarf_id"])
            .groupBy("profession").agg(F.count("task_id").alias("unfinished_tasks"))
            .orderBy(F.desc("unfinished_tasks")))


def avg_age_by_item_type(t: Tables) -> DataFrame:
    """AVG(age) over item x owner pairs: a person counts once per item."""
    i = t["Items"].select("type", "owner_id")
    d = t["Dwarves"].select("dwarf_id", "age")
    return (i.join(d, i["owner_id"] == d["dwarf_id"])
            .groupBy("type").agg(F.avg("age").alias("avg_age")))


def older_than_average_without_items(t: Tables) -> DataFrame:
    """Age above the global average and no items.

    ``HAVING age > (SELECT AVG(age)) AND COUNT(item) = 0`` is a left-anti
    join against the item owners plus a comparison with a one-row global
    aggregate (broadcast: it is one row by construction).
    """
    d = t["Dwarves"]
    avg_age = d.agg(F.avg("age").alias("_avg_age"))
    owners = t["Items"].select(F.col("owner_id").alias("dwarf_id"))
    return (anti(d.select("dwarf_id", "name", "age"), owners, "dwarf_id")
            .crossJoin(F.broadcast(avg_age))
            .where(F.col("age") > F.col("_avg_age"))
            .select("dwarf_id", "name"))


def squads_without_leader(t: Tables) -> DataFrame:
    """W09 as intended: ``leader_id IS NULL``."""
    return t["Squads"].where(F.col("leader_id").isNull()).select("squad_id", "name")


def older_of_profession(t: Tables, min_age=150, profession: str = "Warrior") -> DataFrame:
    """Range + equality filter."""
    return (t["Dwarves"].where((F.col("age") > min_age) & (F.col("profession") == profession))
            .select("dwarf_id", "name", "age", "profession"))


def owners_of_type(t: Tables, item_type: str = "weapon", distinct: bool = False) -> DataFrame:
    """Persons joined to their items of a type -- one row per item.

    ``distinct=True`` is the evident intent (each person once): a
    left-semi join.
    """
    d = t["Dwarves"].select("dwarf_id", "name", "age", "profession")
    items = t["Items"].where(F.col("type") == item_type).select(F.col("owner_id").alias("dwarf_id"))
    return semi(d, items, "dwarf_id") if distinct else d.join(items, "dwarf_id")


def tasks_by_status(t: Tables, none_status: str = "-") -> DataFrame:
    """Persons x task status with count; persons without tasks get
    ``('-', 0)``.  Tasks are pre-counted per (assignee, status), then
    left-joined (no fan-out).  Sorted by name, then status."""
    tc = (t["Tasks"].where(F.col("assigned_to").isNotNull())
          .groupBy(F.col("assigned_to").alias("dwarf_id"), F.col("status").alias("t_status"))
          .agg(F.count("task_id").alias("task_count")))
    d = t["Dwarves"].select("dwarf_id", "name")
    return (d.join(tc, "dwarf_id", "left")
            .orderBy("name", "t_status")
            .select("dwarf_id", "name", ifnull("t_status", none_status).alias("status"),
                    ifnull("task_count", 0).alias("task_count")))


def tasks_of_squad(t: Tables, squad_name: str = "Guardians") -> DataFrame:
    """Tasks of members of the named squad(s); task columns only.

    The squad filter reaches the scan; when squad names are unique per
    squad the chain is a semi join, but several squads may share a name and
    the text then repeats tasks, so the inner-join shape is kept.
    """
    s = t["Squads"].where(F.col("name") == squad_name).select("squad_id")
    d = t["Dwarves"].select("dwarf_id", "squad_id").join(s, "squad_id")
    tasks = t["Tasks"]
    return tasks.join(d, tasks["assigned_to"] == d["dwarf_id"]).select(*[tasks[c] for c in tasks.columns])


def relationships_both_ways(t: Tables) -> DataFrame:
    """Every edge listed from both ends, ordered by the two names."""
    return (edge_both_ways(t["Dwarves"], t["Relationships"], "dwarf_id", "name",
                           "dwarf_id", "related_to", "relationship")
            .orderBy("name", "related_name"))
