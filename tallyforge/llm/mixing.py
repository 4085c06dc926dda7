"""Mixing sources to target weights by systematic sampling.

Sources in code-point order (null last) get the given weights in turn and
share all words; a target stops at ``cap`` times its source's words and the
excess goes to the others by weight.  Within a source every document has
the same expected number of copies, target / source words; the copies are
the integer boundaries that the running sum of expected copies, moved by
one random offset, crosses at the document.  Documents run in order of
size, so a source's taken words stay within about one long document of its
target.

The running sum has two levels: counts per (source, size class, hash part)
give each part its start, and positions are numbered inside a part.  A
source with a third of all rows is spread over ``256`` parts per size
class, so no task holds a whole source.

Defined results: null text and text without words have size 0 and take 0
words (rows of size 0 still get copies like any other); null source is a
source of its own, sorted last; a source without words has target 0 and no
copies; repeated rows are separate documents; an empty table gives an empty
result.  Input columns named like an output column are replaced.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .util import WORD, cut, without

WEIGHTS = (5, 2, 1)
CAP = 3
SEED = 20
OUT = ("size", "source_size", "target", "expected", "copies", "taken")


def random_offset(seed: int) -> float:
    return random.Random(seed).random()


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """``sizes`` (_s, _null, source_size), one row per source -> + target.

    The targets are min(cap * size, level * weight); sources sorted by
    cap * size / weight fill up first, so the level follows from one running
    sum.  One row per source reaches these windows."""
    order = W.orderBy("_null", "_s")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("*", w.alias("_w")).withColumn("_full", F.col("source_size") * float(cap) / F.col("_w"))
    by = W.orderBy("_full", "_null", "_s")
    before, after = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy(F.lit(1))
    s = s.select("*", F.sum("source_size").over(everything).alias("_total"),
                 F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("_capped"),
                 F.sum("_w").over(after).alias("_wleft"))
    level = (F.col("_total") - float(cap) * F.col("_capped")) / F.col("_wleft")
    s = s.withColumn("_level", level)
    first = F.struct("_full", "_null", "_s", "_level")         # the first source that the level leaves unfilled
    s = s.withColumn("_level", F.min(F.when(F.col("_level") <= F.col("_full"), first)).over(everything)["_level"])
    target = F.least(F.col("source_size") * float(cap), F.col("_level") * F.col("_w"))
    return s.select("_s", "_null", "source_size", target.alias("target"))


def size_class(size: str):
    """Integer class of a size: eight steps per power of two."""
    bits = f"cast(length(bin({size})) as int)"
    return F.expr(f"cast({bits} * 8 + shiftright({size}, greatest({bits} - 3, 0)) as int)")


def mix(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: int = SEED) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with size, source_size, target,
    expected (copies), copies and taken."""
    u = F.lit(random_offset(seed))
    d = without(docs, *OUT).withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))
    d = (d.withColumn("_s", F.coalesce("source", F.lit(""))).withColumn("_null", F.col("source").isNull())
         .withColumn("_c", size_class("size"))
         .withColumn("_h", F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 2)))
    part = ["_s", "_null", "_c", "_h"]
    counts = cut(d.groupBy(*part).agg(F.count("*").alias("_n"), F.sum("size").alias("_words")))
    targets = source_targets(counts.groupBy("_s", "_null").agg(F.sum("_words").alias("source_size")), weights, cap)
    before = W.partitionBy("_s", "_null").orderBy("_c", "_h").rowsBetween(W.unboundedPreceding, -1)
    starts = (counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0)))
              .join(targets, ["_s", "_null"]).select(*part, "_start", "source_size", "target"))
    at = F.row_number().over(W.partitionBy(*part).orderBy("size", "doc_id", F.xxhash64("text")))
    e = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    out = (d.withColumn("_at", at).join(starts, part)
           .withColumn("expected", e).withColumn("_i", F.col("_start") + F.col("_at")))
    crossed = (F.floor(F.col("_i") * F.col("expected") + u) - F.floor((F.col("_i") - 1) * F.col("expected") + u)).cast("long")
    return (out.withColumn("copies", F.least(crossed, F.ceil("expected")))
            .withColumn("taken", F.col("copies") * F.col("size")).drop(*part, "_at", "_i", "_start"))


def emit(mixed: DataFrame, copy: str = "copy") -> DataFrame:
    """One row per copy (``copy`` = 1, 2, ...); documents without a copy go."""
    return (mixed.where("copies > 0")
            .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))))
