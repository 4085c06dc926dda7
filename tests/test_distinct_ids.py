"""Several exact distinct counts by mergeable words of id bits."""

import random

from pyspark.sql import functions as F

from tallyforge.functions import count_distinct_ids
from tallyforge.plans.catalogue import QUERIES


def test_counts_against_sets(spark):
    rng = random.Random(2)
    far = [-2**63, 2**63 - 1, -1, 0, 1, 63, 64, -64, -65]
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, *far, *range(-200, 200)]), rng.choice([None, rng.randrange(50)]), rng.randrange(9)) for _ in range(3000)]
    rows += [("empty", None, None, 1)] + [("hot", i % 700, i, 1) for i in range(5000)]
    df = spark.createDataFrame(rows, "k string, x long, y int, q long").repartition(6)
    got = {r.k: (r.s, r.nx, r.ny) for r in count_distinct_ids(df, ["k"], {"nx": "x", "ny": "y"}, [F.sum("q").alias("s")]).collect()}
    want = {}
    for k in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == k]
        want[k] = (sum(r[3] for r in own), len({r[1] for r in own} - {None}), len({r[2] for r in own} - {None}))
    assert got == want
    one = count_distinct_ids(df, [], {"nx": "x"}).collect()
    assert [tuple(r) for r in one] == [(len({r[1] for r in rows} - {None}),)]
    assert count_distinct_ids(df.limit(0), ["k"], {"nx": "x"}).count() == 0


def test_no_row_is_copied_per_count(spark):
    p = QUERIES["count_distinct_multi"][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in p and "partial_bit_or" in p
