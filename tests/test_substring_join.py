"""The substring join against the CHARINDEX form."""

import random

import pytest
from pyspark.sql import functions as F

from tallyforge.operators.joins import substring_join


def naive(keys, lists, how):
    out = []
    for k in keys:
        hit = [(k[0], k[1], i, t) for i, t in lists if k[0] not in (None, "") and t is not None and str(k[0]) in t]
        out += hit or ([(k[0], k[1], None, None)] if how == "left" else [])
    return sorted(out, key=repr)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh "])
def test_text_keys(spark, how, letters):
    rng = random.Random(len(letters))
    word = lambda n: "".join(rng.choice(letters) for _ in range(n))
    lists = [(i, rng.choice([None, "", word(rng.randrange(1, 40))])) for i in range(150)]
    keys = [(word(rng.randrange(0, 9)), i) for i in range(120)] + [(None, 500), ("", 501), ("a" * 60, 502)]
    keys += [(lists[i][1], 600 + i) for i in range(20)] + keys[:3]                  # whole lists, repeated keys
    k = spark.createDataFrame(keys, "k string, tag int")
    t = spark.createDataFrame(lists, "id int, t string")
    got = substring_join(k, "k", t, "t", how)
    assert sorted((tuple(r[c] for c in ("k", "tag", "id", "t")) for r in got.collect()), key=repr) == naive(keys, lists, how)


def test_integer_keys(spark):
    rng = random.Random(4)
    lists = [(i, ",".join(str(rng.randrange(-40, 5000)) for _ in range(rng.randrange(0, 9)))) for i in range(200)] + [(900, None), (901, "x12y345-6")]
    keys = [(x, x) for x in [*range(0, 60), *range(100, 140), 345, -6, -12, 4999, 12345]]
    k, t = spark.createDataFrame(keys, "k int, tag int"), spark.createDataFrame(lists, "id int, t string")
    got = substring_join(k, "k", t, "t", "left", pattern="^-?[0-9]+$", key_chars="[-0-9]")
    assert sorted((tuple(r[c] for c in ("k", "tag", "id", "t")) for r in got.collect()), key=repr) == naive(keys, lists, "left")


def test_candidates_do_not_grow_with_the_longest_key(spark):
    t = spark.createDataFrame([(1, "x" + "abcdefghij" * 30)], "id int, t string")
    k = spark.createDataFrame([("abc" + "q" * n,) for n in (0, 50, 500)], "k string")
    p = substring_join(k, "k", t, "t")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p and "Cartesian" not in p
    from tallyforge.operators.joins import GRAM, substring_keys
    n = t.select(F.size(substring_keys(F.col("t"), GRAM, min_len=GRAM))).first()[0]
    assert n <= 301
