"""Parent documents with child-id arrays (v2 schema): fortress, dwarf,
workshop, squad.  One row per parent, parent columns kept (NULLs too),
``related_entities`` = struct of sorted id arrays, ``[]`` when a parent has
no children.  Each child table is grouped alone and left-joined, so the
arrays never multiply each other.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.nested import Child, related_ids

Tables = Mapping[str, DataFrame]


def fortress_children(t: Tables) -> dict[str, Child]:
    return {
        "dwarf_ids": Child(t["DWARVES"], "fortress_id", "dwarf_id"),
        "resource_ids": Child(t["FORTRESS_RESOURCES"], "fortress_id", "resource_id"),
        "workshop_ids": Child(t["WORKSHOPS"], "fortress_id", "workshop_id"),
        "squad_ids": Child(t["MILITARY_SQUADS"], "fortress_id", "squad_id"),
    }


def fortress_document(t: Tables) -> DataFrame:
    p = t["FORTRESSES"].select("fortress_id", "name", "location", "founded_year", "depth", "population")
    return related_ids(p, "fortress_id", fortress_children(t))


def dwarf_document(t: Tables) -> DataFrame:
    p = t["DWARVES"].select("dwarf_id", "name", "age", "profession")
    return related_ids(p, "dwarf_id", {
        "skill_ids": Child(t["DWARF_SKILLS"], "dwarf_id", "skill_id"),
        "assignment_ids": Child(t["DWARF_ASSIGNMENTS"], "dwarf_id", "assignment_id"),
        "squad_ids": Child(t["SQUAD_MEMBERS"], "dwarf_id", "squad_id"),
        "equipment_ids": Child(t["DWARF_EQUIPMENT"], "dwarf_id", "equipment_id"),
    })


def workshop_children(t: Tables) -> dict[str, Child]:
    return {
        "craftsdwarf_ids": Child(t["WORKSHOP_CRAFTSDWARVES"], "workshop_id", "dwarf_id"),
        "project_ids": Child(t["PROJECTS"], "workshop_id", "project_id"),
        "input_material_ids": Child(t["WORKSHOP_MATERIALS"], "workshop_id", "material_id",
                                    F.col("is_input") == 1),
        "output_product_ids": Child(t["WORKSHOP_PRODUCTS"], "workshop_id", "product_id"),
    }


def workshop_document(t: Tables) -> DataFrame:
    p = t["WORKSHOPS"].select("workshop_id", "name", "type", "quality")
    return related_ids(p, "workshop_id", workshop_children(t))


def squad_children(t: Tables) -> dict[str, Child]:
    return {
        "member_ids": Child(t["SQUAD_MEMBERS"], "squad_id", "dwarf_id"),
        "equipment_ids": Child(t["SQUAD_EQUIPMENT"], "squad_id", "equipment_id"),
        "operation_ids": Child(t["SQUAD_OPERATIONS"], "squad_id", "operation_id"),
        "training_schedule_ids": Child(t["SQUAD_TRAINING"], "squad_id", "schedule_id"),
        "battle_report_ids": Child(t["SQUAD_BATTLES"], "squad_id", "report_id"),
    }


def squad_document(t: Tables) -> DataFrame:
    p = t["MILITARY_SQUADS"].select("squad_id", "name", "formation_type", "leader_id")
    return related_ids(p, "squad_id", squad_children(t))
