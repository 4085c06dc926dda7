"""W21 squad effectiveness: one document per squad."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import count_where, pct, ratio
from ..operators.factor import within_key_zero_corr
from ..operators.joins import summary_star
from ..operators.nested import Child, related_ids
from ..operators.once import compute_once
from ..operators.scoring import weighted_score, with_global_max
from ..operators.temporal import extremes_around

Tables = Mapping[str, DataFrame]


def squad_effectiveness(t: Tables, wins=("Victory", "Success")) -> DataFrame:
    s = t["MILITARY_SQUADS"]
    lead = t["DWARVES"].select(F.col("dwarf_id").alias("leader_id"), F.col("name").alias("leader_name"))
    base = (s.select("squad_id", F.col("name").alias("squad_name"), "formation_type", "leader_id")
            .join(lead, "leader_id", "left").drop("leader_id"))
    sb = t["SQUAD_BATTLES"]
    win = F.col("outcome").isin(list(wins))
    battles = sb.groupBy("squad_id").agg(
        F.count(F.lit(1)).alias("total_battles"), count_where(win).alias("victories"),
        F.sum("casualties").alias("total_casualties"), F.sum("enemy_casualties").alias("total_enemy_casualties"),
        F.min("date").alias("first_battle"), F.max("date").alias("last_battle"))
    sm = t["SQUAD_MEMBERS"]
    members = sm.groupBy("squad_id").agg(
        F.count_distinct("dwarf_id").alias("total_members_ever"),
        count_where(F.col("exit_date").isNull()).alias("current_members"))
    squad_eq = t["SQUAD_EQUIPMENT"].join(t["EQUIPMENT"].select("equipment_id", "quality"), "equipment_id")
    equipment = squad_eq.groupBy("squad_id").agg(F.avg("quality").alias("avg_equipment_quality"))
    st = t["SQUAD_TRAINING"]
    training = st.groupBy("squad_id").agg(
        F.count(F.lit(1)).alias("total_training_sessions"),
        F.avg("effectiveness").alias("avg_training_effectiveness"))
    corr = within_key_zero_corr(
        st.select("squad_id", "effectiveness"),
        sb.select("squad_id", F.when(win, 1).otherwise(0).alias("victory_flag")),
        "squad_id", "effectiveness", "victory_flag", "training_battle_correlation")

    # Skill gain per (squad, member) between the squad's first and last
    # battle; members without skill rows have no gain row (inner join).
    ds = t["DWARF_SKILLS"].select("dwarf_id", "date", "experience")
    spans = (sm.select("squad_id", "dwarf_id").distinct()
             .join(battles.select("squad_id", "first_battle", "last_battle"), "squad_id")
             .join(ds.select("dwarf_id").distinct(), "dwarf_id", "left_semi"))
    gains = extremes_around(ds, spans, "dwarf_id", "date", "experience",
                            "first_battle", "last_battle", "exp_before", "exp_after")
    skill_summary = compute_once(gains.groupBy("squad_id").agg(F.avg(
        F.coalesce("exp_after", F.lit(0)) - F.coalesce("exp_before", F.lit(0))).alias("avg_combat_skill_improvement")))

    j = summary_star(base, "squad_id", [battles, members, equipment, training, corr, skill_summary])
    # MAX(...) OVER () of the text: a one-row aggregate over the squads of
    # the result, broadcast, instead of a single-partition window.
    j = with_global_max(j, {"_max_skill": "avg_combat_skill_improvement"},
                        source=skill_summary.join(base.select("squad_id"), "squad_id", "left_semi"))
    cas, enemy = F.col("total_casualties"), F.col("total_enemy_casualties")
    score = weighted_score([
        (0.20, ratio("victories", "total_battles", guard=1)),
        (0.15, F.lit(1.0) - ratio(cas, cas + enemy, guard=1)),
        (0.10, ratio("current_members", "total_members_ever", guard=1)),
        (0.10, F.col("avg_equipment_quality") / F.lit(5.0)),
        (0.15, F.col("avg_training_effectiveness")),
        (0.15, ratio("avg_combat_skill_improvement", "_max_skill", guard=1)),
        (0.15, F.col("training_battle_correlation")),
    ], dtype="decimal(5,3)")
    out = j.select(
        "squad_id", "squad_name", "formation_type", "leader_name", "total_battles", "victories",
        pct("victories", "total_battles", guard=0).alias("victory_percentage"),
        pct(cas, cas + enemy, guard=0).alias("casualty_rate"),
        # an unbounded ratio: widened from DECIMAL(5,2) so a large value
        # does not fail the job with a cast overflow
        ratio(enemy, cas, guard=1, dtype="decimal(18,2)").alias("casualty_exchange_ratio"),
        "current_members", "total_members_ever",
        # open rows over distinct members: passes 100 when a member has several
        # open rows, so widened from DECIMAL(5,2) like the exchange ratio
        pct("current_members", "total_members_ever", guard=0, dtype="decimal(18,2)").alias("retention_rate"),
        "avg_equipment_quality", "total_training_sessions", "avg_training_effectiveness",
        "training_battle_correlation", "avg_combat_skill_improvement",
        score.alias("overall_effectiveness_score"))
    return related_ids(out, "squad_id", {
        "member_ids": Child(sm, "squad_id", "dwarf_id"),
        "equipment_ids": Child(squad_eq, "squad_id", "equipment_id"),
        "battle_report_ids": Child(sb, "squad_id", "report_id"),
        "training_ids": Child(st, "squad_id", "schedule_id"),
    })
