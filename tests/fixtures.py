"""Seeded random fixtures in the report schemas (v1 and v2).

Small key ranges make every edge the reports care about likely: NULL and
dangling foreign keys, parents without children, duplicated child rows,
zero and one denominators, constant groups, NULL measures, substring
lists where '1' sits inside '12'.  Several seeds are used by the tests.
"""

from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal


def _pick(r, choices, nulls=0.0):
    return None if nulls and r.random() < nulls else r.choice(choices)


def _int(r, lo, hi, nulls=0.0):
    return None if nulls and r.random() < nulls else r.randint(lo, hi)


def _date(r, start, span, nulls=0.0):
    return None if nulls and r.random() < nulls else start + dt.timedelta(days=r.randint(0, span))


def _money(r, nulls=0.0):
    return None if nulls and r.random() < nulls else Decimal(r.choice(["0.00", "1.50", "10.00", "99.99", "250.25",
                                                                        "1000.00", "7.77"]))


D0 = dt.date(2020, 1, 1)


def v1_tables(seed: int) -> dict[str, tuple[str, list[tuple]]]:
    r = random.Random(seed)
    dw = [(i, f"D{i:02d}", r.choice([4000.0, 5000.0, 5000.5, 6200.25, 7000.0, -10.0]),
           _pick(r, ["BUILDING", "MACHINERY", "miner"]), _pick(r, [0, 1, 2, 7, 99], 0.15)) for i in range(14)]
    sq = [(i, f"NATION_{i}", _pick(r, ["hold", "raid"]), _pick(r, [1, 2, 3], 0.4)) for i in (0, 1, 2, 7, 8)]
    tasks = [(100 + i, _pick(r, ["F", "O", "P"], 0.1), _pick(r, ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
              _pick(r, list(range(14)) + [99], 0.1)) for i in range(30)]
    items = [(200 + i, _pick(r, list(range(10)) + [99], 0.1), _pick(r, ["F", "O"])) for i in range(16)]
    rel = [(r.randint(0, 13), r.randint(0, 13), _pick(r, ["A", "N", "R"])) for _ in range(10)]
    rel.append(rel[0])
    return {
        "Dwarves": ("dwarf_id bigint, name string, age double, profession string, squad_id bigint", dw),
        "Squads": ("squad_id bigint, name string, mission string, leader_id bigint", sq),
        "Tasks": ("task_id bigint, status string, priority string, assigned_to bigint", tasks),
        "Items": ("item_id bigint, owner_id bigint, type string", items),
        "Relationships": ("dwarf_id bigint, related_to bigint, relationship string", rel),
    }


def v2_tables(seed: int) -> dict[str, tuple[str, list[tuple]]]:
    r = random.Random(seed)
    nd, nw, ns, ne, nc = 16, 6, 5, 12, 10
    dw = list(range(nd))
    t: dict[str, tuple[str, list[tuple]]] = {}
    t["FORTRESSES"] = ("fortress_id bigint, name string, location string, founded_year int, depth int, population int",
                       [(i, f"F{i}", _pick(r, ["hill", "cave"], 0.3), _int(r, 100, 200, 0.3), _int(r, 1, 9, 0.3),
                         _int(r, 10, 90, 0.3)) for i in range(4)])
    t["DWARVES"] = ("dwarf_id bigint, name string, age int, profession string, fortress_id bigint",
                    [(i, f"D{i}", r.randint(20, 300), _pick(r, ["miner", "smith"]), _pick(r, [0, 1, 2, 9]))
                     for i in dw])
    t["FORTRESS_RESOURCES"] = ("fortress_id bigint, resource_id bigint",
                               [(r.choice([0, 1, 9]), r.randint(1, 6)) for _ in range(8)])
    t["WORKSHOPS"] = ("workshop_id bigint, name string, type string, quality int, fortress_id bigint",
                      [(i, f"W{i}", _pick(r, ["Forge", "Loom"]), r.randint(1, 5), _pick(r, [0, 1, 9]))
                       for i in range(nw)])
    t["MILITARY_SQUADS"] = ("squad_id bigint, name string, formation_type string, leader_id bigint, fortress_id bigint",
                            [(i, f"S{i}", _pick(r, ["line", "wedge"]), _pick(r, dw + [99], 0.3), _pick(r, [0, 1, 9]))
                             for i in range(ns)])
    t["DWARF_SKILLS"] = ("dwarf_id bigint, skill_id bigint, date date, experience int, level int, skill_type string",
                         [(r.choice(dw[:12]), 500 + i, _date(r, D0, 400), r.randint(0, 50), r.randint(1, 5),
                           _pick(r, ["Combat", "Craft"])) for i in range(50)])
    t["DWARF_ASSIGNMENTS"] = ("assignment_id bigint, dwarf_id bigint",
                              [(600 + i, r.choice(dw)) for i in range(10)])
    t["SQUAD_MEMBERS"] = ("squad_id bigint, dwarf_id bigint, exit_date date",
                          [(r.randint(0, ns), r.choice(dw), _date(r, D0, 300, 0.6)) for _ in range(22)])
    t["DWARF_EQUIPMENT"] = ("equipment_id bigint, dwarf_id bigint", [(r.randint(1, 8), r.choice(dw)) for _ in range(10)])
    t["WORKSHOP_CRAFTSDWARVES"] = ("workshop_id bigint, dwarf_id bigint",
                                   [(r.randint(0, nw), r.choice(dw)) for _ in range(14)])
    t["PROJECTS"] = ("project_id bigint, workshop_id bigint", [(700 + i, r.randint(0, nw)) for i in range(8)])
    t["WORKSHOP_MATERIALS"] = ("workshop_id bigint, material_id bigint, is_input int, quantity int",
                               [(r.randint(0, nw), r.randint(1, 9), r.choice([0, 1]), r.choice([0, 1, 2, 5]))
                                for _ in range(14)])
    t["WORKSHOP_PRODUCTS"] = ("workshop_id bigint, product_id bigint, production_date timestamp_ntz, quantity int",
                              [(r.randint(0, nw - 2), r.randint(1, 9),
                                dt.datetime(2021, 1, 1) + dt.timedelta(hours=r.randint(0, 24 * 20)),
                                r.randint(1, 6)) for _ in range(20)])
    t["PRODUCTS"] = ("product_id bigint, value decimal(18,2), quality int, type string",
                     [(i, _money(r), _int(r, 1, 3, 0.2), _pick(r, ["Tool", "Gem"])) for i in range(1, 9)])
    t["SQUAD_EQUIPMENT"] = ("squad_id bigint, equipment_id bigint", [(r.randint(0, ns), r.randint(1, 8)) for _ in range(8)])
    t["EQUIPMENT"] = ("equipment_id bigint, quality int", [(i, r.randint(1, 5)) for i in range(1, 8)])
    t["SQUAD_OPERATIONS"] = ("squad_id bigint, operation_id bigint", [(r.randint(0, ns), 800 + i) for i in range(6)])
    t["SQUAD_TRAINING"] = ("squad_id bigint, schedule_id bigint, effectiveness double",
                           [(r.randint(0, ns - 1), 900 + i, _pick(r, [0.5, 0.75, 0.9], 0.1)) for i in range(14)])
    t["SQUAD_BATTLES"] = ("squad_id bigint, report_id bigint, outcome string, casualties int, enemy_casualties int, "
                          "date date",
                          [(r.randint(0, ns - 1), 1000 + i, _pick(r, ["Victory", "Success", "Defeat", "Repelled",
                                                                       "Partial Breach"]),
                            r.choice([0, 1, 3]), r.choice([0, 2, 5]), _date(r, D0, 400)) for i in range(16)])
    t["EXPEDITIONS"] = ("expedition_id bigint, destination string, status string, departure_date date, return_date date",
                        [(i, f"X{i}", _pick(r, ["Completed", "Lost"]), _date(r, D0, 200), None) for i in range(ne)])
    t["EXPEDITIONS"] = (t["EXPEDITIONS"][0], [(i, d, s, dep, None if r.random() < 0.15 else dep +
                                               dt.timedelta(days=r.choice([0, 3, 30])))
                                              for i, d, s, dep, _ in t["EXPEDITIONS"][1]])
    t["EXPEDITION_MEMBERS"] = ("expedition_id bigint, dwarf_id bigint, survived int",
                               [(r.randint(0, ne - 1), r.choice(dw[:8]), r.choice([0, 1])) for _ in range(26)])
    t["EXPEDITION_ARTIFACTS"] = ("expedition_id bigint, artifact_id bigint, value decimal(18,2)",
                                 [(r.randint(0, ne), 1100 + i, _money(r, 0.1)) for i in range(10)])
    t["EXPEDITION_SITES"] = ("expedition_id bigint, site_id bigint", [(r.randint(0, ne), r.randint(1, 5)) for _ in range(10)])
    t["EXPEDITION_CREATURES"] = ("expedition_id bigint, outcome string",
                                 [(r.randint(0, ne), _pick(r, ["Success", "Victory", "Defeat"])) for _ in range(12)])
    t["CARAVANS"] = ("caravan_id bigint, civilization_type string",
                     [(i, _pick(r, ["Elves", "Humans", "Goblins"])) for i in range(nc)])
    t["TRADE_TRANSACTIONS"] = ("caravan_id bigint, value decimal(18,2), balance_direction string, date date",
                               [(r.randint(0, nc), _money(r), _pick(r, ["positive", "negative", "even"], 0.1),
                                 _date(r, D0, 700)) for _ in range(24)])
    t["DIPLOMATIC_EVENTS"] = ("caravan_id bigint, relationship_change int",
                              [(r.randint(0, nc), _int(r, -5, 5, 0.2)) for _ in range(14)])
    t["CARAVAN_GOODS"] = ("caravan_id bigint, material_type string, quantity int, material_id bigint, "
                          "original_product_id bigint",
                          [(r.randint(0, nc), _pick(r, ["Exotic Metals", "Lumber", "Stone"], 0.1), r.randint(1, 9),
                            _int(r, 1, 9, 0.1), _int(r, 1, 9, 0.3)) for _ in range(16)])
    lists = ["12,3", "21", "2, 12", None, "1", "3,21,2", "5"]
    nl = 5
    t["creature_attacks"] = ("attack_id bigint, creature_id bigint, casualties int, outcome string, "
                             "enemy_casualties int, defense_structures_used string, location_id bigint, date date",
                             [(1200 + i, r.randint(0, 7), r.choice([0, 0, 1, 2]),
                               _pick(r, ["Repelled", "Breached", "Fled"]), _int(r, 0, 9, 0.2), r.choice(lists),
                               r.randint(0, nl), _date(r, dt.date(2019, 1, 1), 1500)) for i in range(24)])
    t["defense_structures"] = ("structure_id bigint, type string, quality int, location_id bigint",
                               [(sid, _pick(r, ["Wall", "Trap"]), r.randint(1, 5), r.randint(0, nl))
                                for sid in (1, 2, 3, 5, 12, 21)])
    t["locations"] = ("location_id bigint, name string, fortification_level int, access_points int",
                      [(i, f"L{i}", r.randint(0, 5), r.randint(0, 4)) for i in range(nl)])
    t["military_stations"] = ("coverage_zone_id bigint, response_time_to_zone int",
                              [(r.randint(0, nl), _int(r, 5, 119, 0.2)) for _ in range(6)])
    t["creatures"] = ("creature_id bigint, type string, active int",
                      [(i, _pick(r, ["Dragon", "Troll"]), r.choice([0, 1, 1])) for i in range(8)])
    as_of = dt.date(2024, 1, 30)
    t["creature_sightings"] = ("sighting_id bigint, creature_id bigint, date date",
                               [(1300 + i, r.randint(0, 8), as_of - dt.timedelta(days=r.choice([1, 30, 89, 90, 91, 200])))
                                for i in range(20)])
    t["creature_territories"] = ("creature_id bigint, danger_level int, distance_to_fortress double",
                                 [(r.randint(0, 8), _int(r, 1, 5, 0.1), r.choice([1.5, 10.0, 22.25]))
                                  for _ in range(12)])
    t["military_coverage_zones"] = ("squad_id bigint, zone_id bigint, response_time_to_zone int",
                                    [(r.randint(0, ns), r.randint(0, nl), r.randint(5, 60)) for _ in range(7)])
    return t


def materialise(spark, con, tables, out_dir):
    """Write fixture tables as parquet; return Spark DataFrames read back and
    register the same files as DuckDB views (identical typed input)."""
    dfs = {}
    for name, (ddl, rows) in tables.items():
        path = f"{out_dir}/{name}.parquet"
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(path)
        dfs[name] = spark.read.parquet(path)
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{path}/*.parquet')")
    return dfs
