"""W23 security report: attack statistics, structure effectiveness (a
substring join), zone vulnerability, military readiness, a yearly
evolution with LAG, and active threats, one DataFrame each.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import count_where, dec, pct, ratio, round_exact
from ..functions.scalar import EXACT
from ..functions.scalar import recent
from ..operators.factor import repeat_factor
from ..operators.joins import substring_join
from ..operators.nested import id_lists, nested_objects

Tables = Mapping[str, DataFrame]

# Fixed values used by the report text.
REPELLED, BREACHED = "Repelled", "Breached"
READY_OUTCOMES = ("Repelled", "Partial Breach")
COMBAT = "Combat"


def attack_stats(t: Tables) -> DataFrame:
    ca = t["creature_attacks"]
    return ca.agg(F.count(F.lit(1)).alias("total_recorded_attacks"),
                  F.count_distinct("creature_id").alias("unique_attackers"),
                  pct(count_where(F.col("casualties") == 0), F.count(F.lit(1)), guard=0)
                  .alias("overall_defense_success_rate"))


def structure_effectiveness(t: Tables) -> DataFrame:
    """Per structure, over structures LEFT JOIN attacks ON CHARINDEX(id,
    defense_structures_used) > 0 -- the substring join, as an equi join on
    exploded substrings (``operators.joins.substring_join``)."""
    ds = t["defense_structures"].select("structure_id", F.col("type").alias("defense_type"), "quality")
    ca = t["creature_attacks"].select("attack_id", "outcome", "enemy_casualties", "defense_structures_used")
    j = substring_join(ds, "structure_id", ca, "defense_structures_used", how="left",
                       pattern="^-?[0-9]+$", key_chars="[-0-9]")
    return j.groupBy("structure_id", "defense_type", "quality").agg(
        F.count_distinct("attack_id").alias("attacks_defended"),
        count_where(F.col("outcome") == REPELLED).alias("successful_defenses"),
        F.avg("enemy_casualties").alias("avg_enemy_casualties"))


def defense_effectiveness(t: Tables) -> DataFrame:
    """Per structure type, sorted by rate; ``structure_ids`` = all structures
    of the type as objects."""
    dse = structure_effectiveness(t)
    g = dse.groupBy("defense_type").agg(
        round_exact(ratio(F.sum("successful_defenses"), F.sum("attacks_defended"), guard=0).cast(EXACT)
                    * dec("100")).alias("effectiveness_rate"),
        round_exact(F.avg("avg_enemy_casualties")).alias("avg_enemy_casualties"))
    ids = t["defense_structures"].select(F.col("type").alias("defense_type"), "structure_id")
    out = nested_objects(g, "defense_type", ids, "defense_type", ["structure_id"], "structure_ids",
                         order=["structure_id"])
    return out.orderBy(F.desc("effectiveness_rate"), "defense_type")


def zone_vulnerability(t: Tables) -> DataFrame:
    """Per location over locations LEFT JOIN attacks, structures and
    stations on the location: the SUM of breaches runs over the product,
    i.e. breaches x max(n_structures, 1) x max(n_stations, 1); the other
    aggregates are distinct counts or a MIN, which the product does not
    change.  Computed from per-location summaries, without the product."""
    loc = t["locations"].select("location_id", F.col("name").alias("zone_name"),
                                "fortification_level", "access_points")
    ca = t["creature_attacks"].groupBy("location_id").agg(
        F.count_distinct("attack_id").alias("total_attacks"),
        count_where(F.col("outcome") == BREACHED).alias("_breach_rows"))
    ds = t["defense_structures"].groupBy("location_id").agg(
        F.count_distinct("structure_id").alias("defense_structures"), F.count(F.lit(1)).alias("_ds_rows"))
    ms = t["military_stations"].groupBy(F.col("coverage_zone_id").alias("location_id")).agg(
        F.min("response_time_to_zone").alias("min_response_time"), F.count(F.lit(1)).alias("_ms_rows"))
    j = loc.join(ca, "location_id", "left").join(ds, "location_id", "left").join(ms, "location_id", "left")
    breaches = (F.coalesce("_breach_rows", F.lit(0)) * repeat_factor(F.col("_ds_rows"))
                * repeat_factor(F.col("_ms_rows")))
    return j.select("location_id", "zone_name", F.coalesce("total_attacks", F.lit(0)).alias("total_attacks"),
                    breaches.alias("breaches"), "fortification_level",
                    F.coalesce("defense_structures", F.lit(0)).alias("defense_structures"),
                    "min_response_time", "access_points")


def vulnerability_analysis(t: Tables) -> DataFrame:
    zv = zone_vulnerability(t)
    # NUMERIC arithmetic as in the text; the two divisions are taken to
    # 10 decimals, the integer terms stay exact.
    score = round_exact(
        ratio("breaches", "total_attacks", guard=0).cast(EXACT) * dec("0.4")
        + (F.lit(5) - F.col("fortification_level")) * dec("0.2")
        + F.col("access_points") * dec("0.1")
        + ((F.lit(120) - F.coalesce("min_response_time", F.lit(120))) / F.lit(120.0)).cast(EXACT) * dec("0.1")
        + (F.lit(3) - F.col("defense_structures")) * dec("0.2"))
    out = zv.select(F.col("location_id").alias("zone_id"), "zone_name", score.alias("vulnerability_score"),
                    F.col("breaches").alias("historical_breaches"), "fortification_level", "access_points")
    structs = t["defense_structures"].select(F.col("location_id").alias("zone_id"), "structure_id")
    out = nested_objects(out, "zone_id", structs, "zone_id", ["structure_id"],
                         "defense_coverage_structures", order=["structure_id"])
    squads = t["military_coverage_zones"].select("zone_id", "squad_id",
                                                 F.col("response_time_to_zone").alias("response_time"))
    out = nested_objects(out, "zone_id", squads, "zone_id", ["squad_id", "response_time"],
                         "defense_coverage_squads", order=["squad_id", "response_time"])
    return out.orderBy(F.desc("vulnerability_score"), "zone_id")


def military_readiness(t: Tables) -> DataFrame:
    """Inner joins squads x member summary x (members' Combat skill rows) x
    battles: squads lacking either side vanish.  Within a squad every skill
    row meets every battle row, which leaves both averages unchanged, so
    each side is aggregated alone and joined 1:1."""
    sm = t["SQUAD_MEMBERS"]
    mem = sm.groupBy("squad_id").agg(F.count(F.lit(1)).alias("total_members"),
                                     count_where(F.col("exit_date").isNull()).alias("current_members"))
    skills = (sm.select("squad_id", "dwarf_id")
              .join(t["DWARF_SKILLS"].where(F.col("skill_type") == COMBAT).select("dwarf_id", "level"), "dwarf_id")
              .groupBy("squad_id").agg(F.avg("level").alias("avg_combat_skill")))
    sb = t["SQUAD_BATTLES"].groupBy("squad_id").agg(
        pct(count_where(F.col("outcome").isin(list(READY_OUTCOMES))), F.count("report_id"), guard=0)
        .alias("combat_effectiveness"))
    s = t["MILITARY_SQUADS"].select("squad_id", F.col("name").alias("squad_name"))
    j = s.join(mem, "squad_id").join(skills, "squad_id").join(sb, "squad_id")
    out = j.select("squad_id", "squad_name",
                   pct("current_members", "total_members", guard=0).alias("readiness_score"),
                   "current_members", "avg_combat_skill", "combat_effectiveness")
    cov = t["military_coverage_zones"].select("squad_id", "zone_id",
                                              F.col("response_time_to_zone").alias("response_time"))
    out = nested_objects(out, "squad_id", cov, "squad_id", ["zone_id", "response_time"],
                         "response_coverage", order=["zone_id", "response_time"])
    return out.orderBy(F.desc("readiness_score"), "squad_id")


def security_evolution(t: Tables) -> DataFrame:
    """Yearly rate and the previous *present* year's rate (LAG over the
    grouped years -- a handful of rows -- not year - 1)."""
    ca = t["creature_attacks"]
    g = ca.groupBy(F.year("date").alias("year")).agg(
        F.count(F.lit(1)).alias("total_attacks"),
        pct(count_where(F.col("casualties") == 0), F.count(F.lit(1)), guard=0).alias("defense_success_rate"))
    return g.withColumn("previous_year_success_rate", F.lag("defense_success_rate").over(Window.orderBy("year"))).orderBy("year")


def active_threats(t: Tables, as_of: str | _dt.datetime, days: int = 90) -> DataFrame:
    """Per creature type over active creatures x recent sightings x
    territories: sightings x territories per creature weight both averages.
    From per-creature summaries: AVG = sum(k_c * S_c) / sum(k_c * t_c) with
    k_c recent sightings and t_c territory rows of creature c."""
    c = t["creatures"].where(F.col("active") == 1).select("creature_id", "type")
    cs = t["creature_sightings"].where(recent("date", as_of, days)).select("creature_id", "sighting_id", "date")
    ct = t["creature_territories"].groupBy("creature_id").agg(
        F.count(F.lit(1)).alias("_t"), F.count("danger_level").alias("_td"),
        F.sum("danger_level").alias("_sd"), F.count("distance_to_fortress").alias("_tx"),
        F.sum("distance_to_fortress").alias("_sx"))
    seen = cs.join(ct.select("creature_id"), "creature_id", "left_semi").join(c, "creature_id")
    per_c = seen.groupBy("creature_id", "type").agg(F.count(F.lit(1)).alias("_k"))
    w = per_c.join(ct, "creature_id").groupBy("type").agg(
        F.try_divide(F.sum(F.col("_k") * F.col("_sd")), F.sum(F.col("_k") * F.col("_td"))).alias("threat_level"),
        F.try_divide(F.sum(F.col("_k") * F.col("_sx")), F.sum(F.col("_k") * F.col("_tx"))).alias("territory_proximity"))
    s = seen.groupBy("type").agg(F.max("date").alias("last_sighting_date"),
                                 F.count_distinct("sighting_id").alias("estimated_numbers"))
    ids = (id_lists(c, "type", "creature_id", "creature_ids", text=True)
           .withColumnRenamed("type", "_t"))
    ws = w.join(s.withColumnRenamed("type", "_s"), w["type"].eqNullSafe(F.col("_s"))).drop("_s")
    return (ws.join(ids, ws["type"].eqNullSafe(ids["_t"]), "left")
            .select(F.col("type").alias("creature_type"), "threat_level", "last_sighting_date",
                    "territory_proximity", "estimated_numbers", "creature_ids"))
