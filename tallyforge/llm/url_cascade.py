"""URL filters by a Bloom filter cascade, with exact answers and no joins
on the query path.

A url's candidate keys are its host's suffixes with its path's prefixes, in
the shapes (number of labels, path length) that the rules have.  Level 1 of
a cascade encodes the listed keys; level 2 encodes those unlisted keys of
the corpus (all candidate keys of all pages, the key universe) that level 1
lets through; level 3 the listed keys that level 2 lets through, and so on
until nothing passes wrongly.  A key is listed iff the first level that
rejects it has an even number.  One cascade holds all rules' keys; the
longest listed key of a url is its rule.  A second cascade, whose universe
is the rules, tells the blocking ones.

Level 1 gets log2(universe / listed) hash functions, so about as many keys
pass wrongly as there are rules and every filter stays a few bytes per rule;
the filters are one-row scalar subqueries of that size, whatever the corpus.

Defined results: a null url or one without ``://`` has empty host and path
and fits no rule; repeated rows are judged alike; without rules every page
gets the default; an empty table gives an empty result.  Ties in length go
to the longer host.  Input columns named like an output column are replaced.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import cut, lower_az, without

OUT = ("host", "path", "rule", "verdict")
MAX_FILTER_BYTES = 256 << 20     # an explicit error beyond; 1.5 bytes a rule or so


def with_url_parts(pages: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    return (pages.withColumn("_rest", rest)
            .withColumn("host", lower_az(F.regexp_extract("_rest", r"^([^/?#]*)([^?#]*)", 1)))
            .withColumn("path", F.regexp_extract("_rest", r"^([^/?#]*)([^?#]*)", 2)).drop("_rest"))


def candidate_keys(shapes: list[tuple[int, int]]) -> Column:
    """The url's keys of the given (labels, path length) shapes."""
    labels = F.split("host", r"\.")

    def one(n, size):
        fits = (F.col("host") != "") & (F.size(labels) >= n) & (F.length("path") >= size)
        suffix = F.array_join(F.slice(labels, -n, n), ".")
        key = F.concat(suffix, F.substring("path", 1, size) if size else F.lit(""))
        return F.when(fits, F.struct((F.length(suffix) + size).alias("n"), F.length(suffix).alias("h"), key.alias("key")))

    return F.array_compact(F.array(*[one(n, s) for n, s in shapes]))


class Level:
    """One Bloom filter: ``bits`` positions, as a one-row frame of longs."""

    def __init__(self, keys: DataFrame, count: int, k: int, seed: int):
        self.k, self.seed = k, seed
        self.bits = 64 * max(1, math.ceil(1.45 * k * max(1, count) / 64))
        if self.bits // 8 > MAX_FILTER_BYTES:
            raise ValueError(f"a filter of {self.bits // 8} bytes is beyond MAX_FILTER_BYTES; split the rules")
        at = keys.select(F.explode(F.array(*self.positions(F.col("key")))).alias("p"))
        words = at.select(F.expr("p div 64").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("b"))
        zero = keys.sparkSession.range(self.bits // 64).select(F.col("id").alias("w"), F.lit(0).cast("long").alias("b"))
        words = words.unionByName(zero).groupBy("w").agg(F.bit_or("b").alias("b"))
        self.frame = cut(words.agg(F.array_sort(F.collect_list(F.struct("w", "b"))).alias("x"))
                         .select(F.col("x.b").alias("words")))

    def positions(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(self.seed * 1000 + i), key), F.lit(self.bits)) for i in range(self.k)]

    def passes(self, words: Column, key: Column) -> Column:
        def bit(p):
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(p, F.lit(64)).cast("int"))
            return F.get(words, F.floor(p / 64).cast("int")).bitwiseAND(mask) != 0

        return reduce(lambda a, b: a & b, [bit(p) for p in self.positions(key)])


class Cascade:
    """Alternating filters for ``listed`` within ``universe`` (column key)."""

    def __init__(self, listed: DataFrame, universe: DataFrame, size: int, seed: int = 1):
        listed = cut(listed.distinct())
        n = listed.count()
        self.levels: list[Level] = []
        k = max(2, math.ceil(math.log2(max(2, size / max(1, n)))))
        self.levels.append(Level(listed, n, k, seed))
        passing = self.through(0, universe).select("key", F.lit(0).alias("l"))
        wrong = (passing.unionByName(listed.select("key", F.lit(1).alias("l")))
                 .groupBy("key").agg(F.max("l").alias("l")).where("l = 0").select("key"))
        inside, test = cut(wrong), listed
        while (n := inside.count()) > 0:
            seed += 1
            self.levels.append(Level(inside, n, 2, seed))
            inside, test = cut(self.through(len(self.levels) - 1, test)), inside

    def bind(self, df: DataFrame, prefix: str, only: int | None = None) -> DataFrame:
        """Add the filters as columns (scalar subqueries, no join)."""
        return df.select("*", *[x.frame.scalar().alias(f"{prefix}{i}") for i, x in enumerate(self.levels)
                                if only in (None, i)])

    def through(self, level: int, keys: DataFrame) -> DataFrame:
        d = self.bind(keys, "_b", level)
        return d.where(self.levels[level].passes(F.col(f"_b{level}"), F.col("key"))).select("key")

    def listed(self, key: Column, prefix: str) -> Column:
        out = None
        for i in reversed(range(len(self.levels))):
            here = self.levels[i].passes(F.col(f"{prefix}{i}"), key)
            out = here if out is None else here & ~out
        return out


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` (url, ...) with host, path, rule and verdict.

    ``rules`` (host, path, verdict 'allow' or 'block'); a rule fits its host
    and all subdomains when the url's path starts with the rule's."""
    rules = cut(rules.select(F.concat(lower_az(F.col("host")), F.col("path")).alias("key"),
                             F.size(F.split("host", r"\.")).alias("n"), F.length("path").alias("s"), "verdict"))
    shapes = [(r.n, r.s) for r in rules.select("n", "s").distinct().orderBy("n", "s").collect()]  # labels x lengths
    d = with_url_parts(without(pages, *OUT))
    if not shapes:
        return d.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    d = d.withColumn("_keys", candidate_keys(shapes))
    universe = d.select(F.explode("_keys.key").alias("key")).distinct()
    listed = Cascade(rules.select("key"), universe, pages.count() * len(shapes))
    blocked = Cascade(rules.where("verdict = 'block'").select("key"), rules.select("key"), rules.count(), seed=500)
    d = blocked.bind(listed.bind(d, "_a"), "_c")
    hits = F.filter("_keys", lambda x: listed.listed(x.key, "_a"))
    d = d.withColumn("rule", F.array_max(hits).key)
    verdict = F.when(F.col("rule").isNull(), F.lit(default)).when(
        blocked.listed(F.col("rule"), "_c"), F.lit("block")).otherwise(F.lit("allow"))
    return d.withColumn("verdict", verdict).select(*[c for c in d.columns if not c.startswith("_")], "verdict")
