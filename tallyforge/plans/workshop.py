"""W20 workshop efficiency: one document per workshop."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pct, ratio, sum_where
from ..functions.scalar import days_between
from ..operators.factor import within_key_zero_corr
from ..operators.joins import summary_star
from ..operators.nested import Child, related_ids

Tables = Mapping[str, DataFrame]
MONEY = "decimal(18,2)"
# The text casts these unbounded ratios to DECIMAL(10,2); under ANSI mode an
# outlier (one huge workshop) would fail the whole job with a cast
# overflow, so they are widened.
WIDE = "decimal(18,2)"


def skill_per_craftsdwarf(t: Tables) -> DataFrame:
    """(workshop, dwarf, avg_skill) for craftsmen that have skill rows.

    AVG(level) over craftsman rows x skill rows: a craftsman listed twice
    repeats every skill row twice and leaves the average unchanged, so the
    average is taken per dwarf once (partial aggregate) and joined to the
    distinct (workshop, dwarf) pairs -- no product of the two lists.
    """
    per_dwarf = t["DWARF_SKILLS"].groupBy("dwarf_id").agg(F.avg("level").alias("avg_skill"))
    pairs = t["WORKSHOP_CRAFTSDWARVES"].select("workshop_id", "dwarf_id").distinct()
    return pairs.join(per_dwarf, "dwarf_id")


def workshop_efficiency(t: Tables) -> DataFrame:
    w = t["WORKSHOPS"].select("workshop_id", F.col("name").alias("workshop_name"),
                              F.col("type").alias("workshop_type"))
    wp = t["WORKSHOP_PRODUCTS"]
    p = t["PRODUCTS"].select("product_id", "value", "quality")
    prod_rows = wp.join(p, "product_id")

    wp_summary = wp.groupBy("workshop_id").agg(
        F.min("production_date").alias("first_prod"), F.max("production_date").alias("last_prod"),
        F.count_distinct(F.to_date("production_date")).alias("active_days"))
    craft = t["WORKSHOP_CRAFTSDWARVES"].groupBy("workshop_id").agg(
        F.count_distinct("dwarf_id").alias("num_craftsdwarves"))
    prod = prod_rows.groupBy("workshop_id").agg(
        F.sum("quantity").alias("total_quantity_produced"),
        F.sum(F.col("quantity") * F.col("value")).cast(MONEY).alias("total_production_value"))
    materials = t["WORKSHOP_MATERIALS"].groupBy("workshop_id").agg(
        sum_where("quantity", F.col("is_input") == 1, 0).alias("total_input_qty"))
    skill = skill_per_craftsdwarf(t)
    avg_skill = skill.groupBy("workshop_id").agg(F.avg("avg_skill").alias("_avg_skill"))
    corr = within_key_zero_corr(skill, prod_rows.select("workshop_id", "quality"), "workshop_id",
                                "avg_skill", "quality", "skill_quality_correlation")

    j = summary_star(w, "workshop_id", [wp_summary, craft, prod, materials, avg_skill, corr])
    period = days_between("first_prod", "last_prod") + 1
    out = j.select(
        "workshop_id", "workshop_name", "workshop_type", "num_craftsdwarves",
        "total_quantity_produced", "total_production_value",
        ratio("total_quantity_produced", period, guard=0, dtype=WIDE).alias("daily_production_rate"),
        ratio("total_production_value", "total_input_qty", guard=1, dtype=WIDE)
        .alias("value_per_material_unit"),
        pct(F.coalesce("active_days", F.lit(0)), period, guard=1).alias("workshop_utilization_percent"),
        ratio("total_quantity_produced", "total_input_qty", guard=1, dtype=WIDE)
        .alias("material_conversion_ratio"),
        F.col("_avg_skill").cast("decimal(5,2)").alias("average_craftsdwarf_skill"),
        "skill_quality_correlation")
    return related_ids(out, "workshop_id", {
        "craftsdwarf_ids": Child(t["WORKSHOP_CRAFTSDWARVES"], "workshop_id", "dwarf_id"),
        "product_ids": Child(prod_rows, "workshop_id", "product_id"),
        "material_ids": Child(t["WORKSHOP_MATERIALS"], "workshop_id", "material_id"),
        "project_ids": Child(t["PROJECTS"], "workshop_id", "project_id"),
    })
