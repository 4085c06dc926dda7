"""Plan-shape tests: the physical plans keep the promised strategies."""

import pytest

from tallyforge.operators.once import checkpoint_folder, compute_once
from tallyforge.operators.temporal import extremes_around
from tallyforge.plans import expedition, security, squad
from tallyforge.plans.catalogue import QUERIES, v2
from tallyforge.sources.driver_views import V2

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_substring_join_is_not_nested_loop(spark):
    t = v2(spark, SF, ["creature_attacks", "defense_structures"])
    p = _plan(security.structure_effectiveness(t))
    assert "NestedLoopJoin" not in p
    assert "CartesianProduct" not in p


def test_global_max_is_not_single_partition_window(spark):
    names = ["MILITARY_SQUADS", "DWARVES", "SQUAD_BATTLES", "SQUAD_MEMBERS", "SQUAD_EQUIPMENT", "EQUIPMENT",
             "SQUAD_TRAINING", "DWARF_SKILLS"]
    p = _plan(squad.squad_effectiveness(v2(spark, SF, names)))
    windows = [ln for ln in p.splitlines() if ln.strip().lstrip("+- :").startswith("Window ")]
    assert not windows                                # MAX() OVER () is an aggregate, the as-of windows ran once


def _scans(monkeypatch, module, build):
    """Scans of ``events`` for skills, in the summary that is computed once
    and in what reads it."""
    once = []
    monkeypatch.setattr(module, "compute_once", lambda df: once.append(df) or compute_once(df))
    rest = build()
    assert len(once) == 1
    skills = lambda df: sum("events.parquet" in ln and "user_id" in ln and "value" in ln
                            for ln in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in ln)
    return skills(once[0]), skills(rest), once[0]


def test_skill_summary_is_computed_once(spark, monkeypatch):
    t = v2(spark, SF, [n for n in V2 if n.startswith("EXPEDITION") or n == "DWARF_SKILLS"])
    inside, outside, summary = _scans(monkeypatch, expedition, lambda: expedition.expedition_scorecard(t))
    assert inside >= 1 and outside == 0
    names = ["MILITARY_SQUADS", "DWARVES", "SQUAD_BATTLES", "SQUAD_MEMBERS", "SQUAD_EQUIPMENT", "EQUIPMENT",
             "SQUAD_TRAINING", "DWARF_SKILLS"]
    inside, outside, summary = _scans(monkeypatch, squad, lambda: squad.squad_effectiveness(v2(spark, SF, names)))
    assert inside > outside                           # squad trainings are events, too
    windows = [ln for ln in _plan(summary).splitlines() if ln.strip().lstrip("+- :").startswith("Window ")]
    assert windows and all("dwarf_id" in w for w in windows)


def test_extremes_share_one_aggregate_and_one_exchange(spark):
    vals = spark.createDataFrame([(1, 5, 3)], "k int, d int, v int")
    probes = spark.createDataFrame([(1, 5, 6, 7)], "k int, s int, e int, x int")
    p = _plan(extremes_around(vals, probes, "k", "d", "v", "s", "e"))
    lines = p.splitlines()
    first = next(i for i, ln in enumerate(lines) if "Window " in ln)
    depth = lambda ln: len(ln) - len(ln.lstrip(" :+-"))
    below = [lines[first]]
    for ln in lines[first + 1:]:
        if depth(ln) <= depth(lines[first]):
            break
        below.append(ln)
    assert sum("Window " in ln for ln in below) == 2                     # min ascending, max descending
    assert sum("Exchange hashpartitioning" in ln for ln in below) == 2   # by (key, day), combined before; then by key
    assert sum("partial_min" in ln for ln in below) == 1
    other = [ln for ln in lines if "Window " in ln]
    assert len(other) == 4 and len({ln.lstrip(" :+-").split("#")[0] for ln in other}) <= 2   # the same two for starts and ends


def test_no_python_udfs_anywhere(spark):
    for key, (fn, _) in QUERIES.items():
        p = _plan(fn(spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key


def test_filters_and_projection_reach_the_scan(spark):
    fn = QUERIES["filter_and"][0]
    df = fn(spark, SF)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_orderpriority), EqualTo(o_orderstatus,F)" in text
    fn = QUERIES["count_distinct_day"][0]
    text = fn(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp_ntz>" in text


def test_only_local_sessions_get_a_folder_of_their_own(spark):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError):
        checkpoint_folder(Session())
    assert checkpoint_folder(spark)
