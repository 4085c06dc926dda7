"""Positions and LAG of large results against sorting in one place."""

import random

from tallyforge.operators.ordered import with_lag, with_position


def rows_of(seed, n=4000):
    rng = random.Random(seed)
    return [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, *range(30)]), i, rng.choice([None, rng.randrange(9)])) for i in range(n)]


def up(x):
    return (x is not None, x if x is not None else 0)


def down(x):
    return (x is None, -x if x is not None else 0)


def test_positions(spark):
    rows = rows_of(1)
    df = spark.createDataFrame(rows, "p string, x int, i int, v int").repartition(7)
    got = {r.i: r.position for r in with_position(df, ["-x", "i"]).collect()}
    want = {r[2]: n for n, r in enumerate(sorted(rows, key=lambda r: (down(r[1]), r[2])), 1)}
    assert got == want
    got = {r.i: r.place for r in with_position(df, ["x", "i"], within=["p"], out="place").collect()}
    want = {}
    for p in {r[0] for r in rows}:
        want |= {r[2]: n for n, r in enumerate(sorted((r for r in rows if r[0] == p), key=lambda r: (up(r[1]), r[2])), 1)}
    assert got == want
    assert with_position(df.limit(0), ["x"]).count() == 0


def test_equal_rows_get_different_places(spark):
    df = spark.createDataFrame([("a", 1)] * 500 + [("b", 1)] * 3, "p string, x int").repartition(5)
    got = sorted((r.p, r.position) for r in with_position(df, ["x"], within=["p"]).collect())
    assert got == [("a", i) for i in range(1, 501)] + [("b", i) for i in range(1, 4)]


def test_lag_with_ties_and_nulls(spark):
    rows = rows_of(2)
    df = spark.createDataFrame(rows, "p string, x int, i int, v int").repartition(7)
    out = with_lag(df, ["x", "i"], "v", "before")
    order = sorted(rows, key=lambda r: (up(r[1]), r[2]))
    want = {r[2]: (order[n - 1][3] if n else None) for n, r in enumerate(order)}
    assert {r.i: r.before for r in out.collect()} == want
    assert with_lag(df.limit(0), ["x"], "v", "b").count() == 0
    assert [tuple(r) for r in with_lag(df.limit(1), ["x"], "i", "b").select("b").collect()] == [(None,)]
