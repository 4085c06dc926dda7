"""W19 expedition scorecard: one row per completed expedition."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import count_where, pct, ratio
from ..functions.scalar import days_between
from ..operators.joins import summary_star
from ..operators.nested import Child, related_ids
from ..operators.once import compute_once
from ..operators.scoring import weighted_score
from ..operators.temporal import extremes_around

Tables = Mapping[str, DataFrame]
MONEY = "decimal(18,2)"


def _skill_by_expedition(t: Tables, base: DataFrame, per_expedition: bool) -> DataFrame:
    """Skill improvement per expedition.

    The text groups gains by (dwarf, expedition) but joins them back **on
    the dwarf only**, so a dwarf on k completed expeditions adds all k
    gains to every expedition it is a member of (any status).  That is
    sum over member rows of G(dwarf), G = the dwarf's total gain, computed
    here per dwarf and joined 1:1 -- the text's member x gain product is
    never formed.  ``per_expedition=True`` joins on both keys instead.
    """
    em = t["EXPEDITION_MEMBERS"].select("expedition_id", "dwarf_id")
    ds = t["DWARF_SKILLS"].select("dwarf_id", "date", "experience")
    trips = (em.join(base.select("expedition_id", "departure_date", "return_date"), "expedition_id")
             .join(ds.select("dwarf_id").distinct(), "dwarf_id", "left_semi"))
    pairs = trips.select("dwarf_id", "expedition_id", "departure_date", "return_date").distinct()
    gain = (extremes_around(ds, pairs, "dwarf_id", "date", "experience",
                            "departure_date", "return_date", "exp_before", "exp_after")
            .select("dwarf_id", "expedition_id",
                    (F.coalesce("exp_after", F.lit(0)) - F.coalesce("exp_before", F.lit(0))).alias("gain")))
    if per_expedition:
        return (em.join(gain, ["dwarf_id", "expedition_id"], "left").groupBy("expedition_id")
                .agg(F.sum(F.coalesce("gain", F.lit(0))).alias("skill_improvement")))
    per_dwarf = gain.groupBy("dwarf_id").agg(F.sum("gain").alias("g"))
    return (em.join(per_dwarf, "dwarf_id", "left").groupBy("expedition_id")
            .agg(F.sum(F.coalesce("g", F.lit(0))).alias("skill_improvement")))


def expedition_scorecard(t: Tables, completed: str = "Completed",
                         success=("Success", "Victory"), per_expedition: bool = False) -> DataFrame:
    ex = t["EXPEDITIONS"]
    base = ex.where(F.col("status") == completed).select(
        "expedition_id", "destination", "status", "departure_date", "return_date")
    members = t["EXPEDITION_MEMBERS"].groupBy("expedition_id").agg(
        F.count(F.lit(1)).alias("total_members"),
        count_where(F.col("survived") == 1).alias("survived_members"))
    arts = t["EXPEDITION_ARTIFACTS"].groupBy("expedition_id").agg(
        F.coalesce(F.sum("value"), F.lit(0)).cast(MONEY).alias("artifacts_value"))
    sites = t["EXPEDITION_SITES"].groupBy("expedition_id").agg(F.count(F.lit(1)).alias("discovered_sites"))
    enc = t["EXPEDITION_CREATURES"].groupBy("expedition_id").agg(
        F.count(F.lit(1)).alias("encounters_total"),
        count_where(F.col("outcome").isin(list(success))).alias("encounters_success"))
    skill = compute_once(_skill_by_expedition(t, base, per_expedition))      # joined, and its maximum taken
    # Scalar subqueries: the maxima of artifacts, sites and skill cover all
    # expeditions, the duration maximum only completed ones.  Each is a
    # one-row aggregate, broadcast onto the result.
    maxima = (arts.agg(F.max("artifacts_value").alias("max_art"))
              .crossJoin(sites.agg(F.max("discovered_sites").alias("max_sites")))
              .crossJoin(skill.agg(F.max("skill_improvement").alias("max_skill")))
              .crossJoin(base.agg(F.max(days_between("departure_date", "return_date")).alias("max_dur"))))
    j = summary_star(base, "expedition_id", [members, arts, sites, enc, skill]).crossJoin(F.broadcast(maxima))
    dur = days_between("departure_date", "return_date")
    sites_c = F.coalesce("discovered_sites", F.lit(0))
    skill_c = F.coalesce("skill_improvement", F.lit(0))
    score = weighted_score([
        (0.30, ratio("survived_members", "total_members", guard=1)),
        (0.25, ratio("artifacts_value", "max_art", guard=1)),
        (0.15, ratio("encounters_success", "encounters_total", guard=1)),
        (0.10, ratio(sites_c, "max_sites", guard=1)),
        (0.10, ratio(skill_c, "max_skill", guard=1)),
        (0.10, F.lit(1.0) - ratio(dur, "max_dur", guard=1)),
    ], dtype="decimal(5,2)")
    scored = j.select(
        "expedition_id", "destination", "status",
        pct("survived_members", "total_members", guard=0).alias("survival_rate"),
        "artifacts_value",
        sites_c.alias("discovered_sites"),
        pct("encounters_success", "encounters_total", guard=0).alias("encounter_success_rate"),
        skill_c.alias("skill_improvement"),
        dur.alias("expedition_duration"),
        score.alias("overall_success_score"))
    # id lists: each child grouped alone, [] when none (COALESCE(csv, ''))
    return related_ids(scored, "expedition_id", {
        "member_ids": Child(t["EXPEDITION_MEMBERS"], "expedition_id", "dwarf_id"),
        "artifact_ids": Child(t["EXPEDITION_ARTIFACTS"], "expedition_id", "artifact_id"),
        "site_ids": Child(t["EXPEDITION_SITES"], "expedition_id", "site_id"),
    }).orderBy(F.desc("overall_success_score"))
