"""Operator-level tests on tiny frames: edge rows and equivalences."""

import random

from pyspark.sql import functions as F

from tallyforge.functions.aggs import trunc_avg
from tallyforge.functions import guarded_corr, id_text, pct, ratio
from tallyforge.operators import joins, nested
from tallyforge.operators.factor import cross_moments, within_key_zero_corr
from tallyforge.operators.temporal import extremes_around


def test_substring_vs_token_pairs(spark):
    # '1' matches inside '12' and '21' for the substring form only
    keys = spark.createDataFrame([(1,), (2,), (12,), (21,)], "sid bigint")
    lists = spark.createDataFrame([(1, "12,3"), (2, "21"), (3, "2, 12"), (4, None)], "aid bigint, used string")
    sub = joins.substring_join(keys, "sid", lists, "used", how="inner")
    tok = joins.token_join(keys, "sid", lists, "used", how="inner")
    assert sub.count() == 9
    assert tok.count() == 4
    assert sorted((r.sid, r.aid) for r in tok.collect()) == [(2, 3), (12, 1), (12, 3), (21, 2)]


import pytest


@pytest.mark.parametrize("key_chars,pattern", [(None, None), ("[-0-9]", "^-?[0-9]+$")])
def test_substring_join_matches_instr(spark, key_chars, pattern):
    r = random.Random(5)
    keys = spark.createDataFrame([(i,) for i in range(0, 130, 7)], "k bigint")
    lists = spark.createDataFrame([(i, "x;".join(str(r.randint(0, 150)) for _ in range(r.randint(0, 4))) or None)
                                   for i in range(40)], "id bigint, txt string")
    fast = joins.substring_join(keys, "k", lists, "txt", how="left", key_chars=key_chars,
                                pattern=pattern).select("k", "id")
    naive = keys.join(lists, F.expr("instr(txt, cast(k as string)) > 0"), "left").select("k", "id")
    assert sorted(map(tuple, fast.collect()), key=repr) == sorted(map(tuple, naive.collect()), key=repr)


def test_anti_join_keeps_null_and_dangling(spark):
    d = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "dwarf_id bigint, squad_id bigint")
    s = spark.createDataFrame([(10,)], "squad_id bigint")
    assert sorted(r.dwarf_id for r in joins.anti(d, s, "squad_id").collect()) == [2, 3]


def test_edge_both_ways(spark):
    n = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, name string")
    e = spark.createDataFrame([(1, 2, "friend"), (1, 2, "friend")], "src bigint, dst bigint, kind string")
    out = joins.edge_both_ways(n, e, "id", "name", "src", "dst", "kind")
    assert sorted(map(tuple, out.collect())) == [("a", "friend", "b")] * 2 + [("b", "friend", "a")] * 2


def test_related_ids_empty_and_sorted(spark):
    p = spark.createDataFrame([(1, None), (2, "x")], "k bigint, label string")
    c = spark.createDataFrame([(2, 5), (2, 3), (2, 3), (7, 1)], "fk bigint, id bigint")
    out = {r.k: r for r in nested.related_ids(p, "k", {"ids": nested.Child(c, "fk", "id")}).collect()}
    assert out[1].related_entities.ids == [] and out[1].label is None
    assert out[2].related_entities.ids == [3, 3, 5]


def test_section_null_when_empty(spark):
    df = spark.createDataFrame([], "a bigint")
    assert nested.section(df, ["a"], "s").collect()[0].s is None


def test_id_text_null_for_no_rows(spark):
    df = spark.createDataFrame([(1, None)], "k bigint, v bigint")
    assert df.groupBy("k").agg(id_text("v").alias("t")).collect()[0].t is None


def test_to_document_null_policy(spark):
    df = spark.createDataFrame([(1, None)], "a bigint, b string")
    assert nested.to_document(df, True).collect()[0].document == '{"a":1,"b":null}'
    assert nested.to_document(df, False).collect()[0].document == '{"a":1}'


def test_ratio_guards(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (3, 2)], "a int, b int")
    got = [tuple(r) for r in df.select(ratio("a", "b", guard=1).alias("g1"), ratio("a", "b", guard=0).alias("g0"),
                                       pct("a", "b", guard=0).alias("p")).collect()]
    assert got[0][0] is None and got[0][1] is None           # 0 denominator: NULL, not an error
    assert got[1][0] is None and got[1][1] == 1.0           # NULLIF(x, 1)
    assert float(got[2][2]) == 150.0


def test_guarded_corr_flat_and_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, None), (1, 2.0, 5.0), (1, 3.0, 5.0), (2, 1.0, 1.0), (2, 2.0, 2.0),
                                (2, 4.0, 3.0)], "g int, x double, y double")
    out = {r.g: r.c for r in df.groupBy("g").agg(guarded_corr("x", "y").alias("c")).collect()}
    assert out[1] is None                 # y constant over its non-NULL values
    assert abs(out[2] - 0.9819805060619657) < 1e-9


def _naive_zero_corr(x, y):
    j = x.join(y, "k")
    return j.groupBy("k").agg(guarded_corr("x", "y").alias("c"))


def test_within_key_zero_corr_matches_naive(spark):
    r = random.Random(7)
    x = spark.createDataFrame([(r.randint(0, 5), r.choice([1.0, 2.0, None])) for _ in range(30)], "k int, x double")
    y = spark.createDataFrame([(r.randint(0, 5), r.choice([0.0, 1.0, 3.0, None])) for _ in range(30)], "k int, y double")
    fast = {row.k: row.c for row in within_key_zero_corr(x, y, "k", "x", "y", "c").collect()}
    slow = {row.k: (None if row.c is None else round(row.c, 9) + 0.0) for row in _naive_zero_corr(x, y).collect()}
    assert fast == slow


def test_cross_moments_matches_naive(spark):
    r = random.Random(11)
    for _ in range(3):
        x = spark.createDataFrame([(r.randint(0, 8), r.choice(["a", "b"]), r.choice([1.0, 2.5, 4.0, None]))
                                   for _ in range(25)], "b int, g string, x double")
        x = x.dropDuplicates(["b", "x"]).join(
            x.groupBy("b").agg(F.first("g").alias("gg")), "b").drop("g").withColumnRenamed("gg", "g")
        y = spark.createDataFrame([(r.randint(0, 10), r.choice([-1, 0, 2, 5, None])) for _ in range(20)],
                                  "b int, y int")
        fast = {row.g: (row.rows, row.x_sum, None if row.corr is None else round(row.corr, 9))
                for row in cross_moments(x, y, "b", "g", "x", "y").collect()}
        j = x.join(y, "b", "left")
        slow = {row.g: (row.rows, row.xs, None if row.c is None else round(row.c, 9))
                for row in j.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.sum("x").alias("xs"),
                                              guarded_corr("x", "y").alias("c")).collect()}
        assert fast == slow


def test_extremes_around_matches_naive(spark):
    import datetime as dt
    r = random.Random(13)
    d0 = dt.date(2020, 1, 1)
    vals = spark.createDataFrame([(r.randint(0, 4), d0 + dt.timedelta(days=r.randint(0, 30)), r.randint(0, 99))
                                  for _ in range(40)], "k int, d date, v int")
    probes = spark.createDataFrame([(i, r.randint(0, 5), d0 + dt.timedelta(days=r.randint(0, 30)),
                                     None if r.random() < 0.2 else d0 + dt.timedelta(days=r.randint(0, 30)))
                                    for i in range(25)], "pid int, k int, s date, e date")
    fast = {row.pid: (row.before, row.after)
            for row in extremes_around(vals, probes, "k", "d", "v", "s", "e").collect()}
    j = probes.join(vals, "k", "left")
    slow = {row.pid: (row.b, row.a) for row in j.groupBy("pid").agg(
        F.min(F.when(F.col("d") <= F.col("s"), F.col("v"))).alias("b"),
        F.max(F.when(F.col("d") >= F.col("e"), F.col("v"))).alias("a")).collect()}
    assert fast == slow


def test_extremes_of_a_hot_key(spark):
    """One key with most rows: its windows see days, not rows."""
    vals = spark.range(30000).selectExpr("IF(id % 10 = 0, id % 7, 99) AS k", "CAST(id * 7919 % 50 AS INT) AS d", "CAST(id * 31 % 1009 AS INT) AS v")
    probes = spark.range(2000).selectExpr("IF(id % 10 = 0, id % 9, 99) AS k", "CAST(id % 53 AS INT) AS s", "CAST(nullif(id % 49, 0) AS INT) AS e", "id")
    got = {r.id: (r.before, r.after) for r in extremes_around(vals, probes, "k", "d", "v", "s", "e").collect()}
    rows = [(r.k, r.d, r.v) for r in vals.collect()]
    by = {}
    for k, d, v in rows:
        by.setdefault(k, {}).setdefault(d, []).append(v)
    for r in probes.collect():
        days = by.get(r.k, {})
        lo = [min(v) for d, v in days.items() if r.s is not None and d <= r.s]
        hi = [max(v) for d, v in days.items() if r.e is not None and d >= r.e]
        assert got[r.id] == (min(lo, default=None), max(hi, default=None))
    assert len(got) == 2000


def test_every_parent_is_one_row_and_every_child_comes_once(spark):
    p = spark.createDataFrame([(1,), (2,), (3,)], "k bigint")
    c = spark.createDataFrame([(1, i) for i in range(40)] + [(2, 7), (2, 7)], "fk bigint, id bigint")
    out = {r.k: r.related_entities.ids for r in nested.related_ids(p, "k", {"ids": nested.Child(c, "fk", "id")}).collect()}
    assert out == {1: list(range(40)), 2: [7, 7], 3: []}
    two = nested.nested_objects(nested.nested_objects(p, "k", c, "fk", ["id"], "a"), "k", c, "fk", ["id"], "b")
    rows = two.where("k = 1").collect()
    assert len(rows) == 1 and len(rows[0].a) == len(rows[0].b) == 40
    long = nested.ids_long("k", {"ids": nested.Child(c, "fk", "id"), "more": nested.Child(c, "fk", "id", F.col("id") < 3)})
    got = sorted(tuple(r) for r in long.collect())
    assert len(got) == 44 and (2, "ids", "7", 2) in got and (1, "more", "2", 1) in got


def test_id_lists_keep_null_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, id bigint")
    out = {r.g: r.ids for r in nested.id_lists(df, "g", "id", "ids").collect()}
    assert out == {None: [1, 2], "a": [3]}


def test_substring_join_finds_long_ids(spark):
    keys = spark.createDataFrame([(12345678901,), (1234567890123456789,), (5,)], "k bigint")
    lists = spark.createDataFrame([("12345678901,5",), ("x1234567890123456789",)], "l string")
    got = sorted((r.k, r.l) for r in joins.substring_join(keys, "k", lists, "l", how="inner", pattern="^-?[0-9]+$", key_chars="[-0-9]").collect())
    naive = sorted((k.k, t.l) for k in keys.collect() for t in lists.collect() if str(k.k) in t.l)
    assert got == naive and (12345678901, "12345678901,5") in got


def test_truncated_average_is_exact_above_2_to_53(spark):
    df = spark.createDataFrame([(1, 9007199254740993), (2, -3), (2, -4), (3, None)], "g int, v bigint")
    got = {r.g: r.a for r in df.groupBy("g").agg(trunc_avg("v").alias("a")).collect()}
    assert got == {1: 9007199254740993, 2: -3, 3: None}
