"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets counts over its whole text.  Four rates (symbols per
1000 words, duplicate lines per 1000 lines, repeated words per 1000 words,
characters per 100 words) go into logarithmic-bucket quantile sketches:
counts per (language, source, rate, bucket), which merge by addition, so a
hot source is reduced before any shuffle.  The quartiles of a group give
its fences, Q1 / Q3 -+ 3 * max(Q3 - Q1, least spread); groups of fewer than
``least_docs`` documents use the merged sketch of their language, small
languages the sketch of everything.  The fences are joined to the documents
by (language, source).

Defined results: null text has no words and fails the base rule; null
language or source is a group of its own; repeated rows get equal verdicts;
an empty table gives an empty result.  Input columns named like an output
column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .util import WORD, cut, without, word_list

GAMMA = 1.02          # sketch buckets: relative error about 1 %
LEAST_DOCS = 100
FENCE = 3.0
# rate -> (least spread, lower fence too)
RATES = {"sym": (50, False), "dup": (150, False), "rep": (75, False), "wlen": (100, True)}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
OUT = (*COUNTS, "base_failed", "kept")
WINDOW = 8


def with_counts(docs: DataFrame) -> DataFrame:
    """The base counts of every whole text."""
    text = F.coalesce("text", F.lit(""))
    d = without(docs, *OUT).withColumn("_w", word_list(F.col("text")))
    d = (d.withColumn("n_words", F.size("_w").cast("long"))
         .withColumn("word_chars", F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long"))
         .withColumn("n_symbols", (F.octet_length(text) - F.octet_length(F.translate(text, "#*$%&|<>", ""))).cast("long"))
         .withColumn("_l", F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD)))
         .withColumn("_h", F.when(F.col("n_words") >= WINDOW, F.transform("_w", lambda w: F.xxhash64(w)))))
    d = (d.withColumn("n_lines", F.size("_l").cast("long"))
         .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
         .withColumn("_g", F.when(F.col("_h").isNotNull(), F.transform(
             F.sequence(F.lit(1), F.size("_h") - (WINDOW - 1)),
             lambda i: F.xxhash64(F.slice(F.col("_h"), i, WINDOW))))))
    # only texts with a repeated window sort their windows
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"),
                                  F.array_sort(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))))
    again = F.filter("_s", lambda x, i: (x.h == F.get(F.col("_s"), i + 1).h)
                     | (F.when(i > 0, F.get(F.col("_s"), i - 1).h) == x.h))
    at = F.array_sort(F.transform(again, lambda x: x.p))
    zero = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(at, zero, lambda a, p: F.struct(
        (a.n + F.least(F.lit(WINDOW), p - a.last)).alias("n"), p.alias("last")), lambda a: a.n)
    return (d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("_w", "_l", "_h", "_g", "_s"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def rates() -> dict[str, Column]:
    return {"sym": F.expr("(1000 * n_symbols) div greatest(n_words, 1)"),
            "dup": F.expr("(1000 * n_dup_lines) div greatest(n_lines, 1)"),
            "rep": F.expr("(1000 * n_repeat_words) div greatest(n_words, 1)"),
            "wlen": F.expr("(100 * word_chars) div greatest(n_words, 1)")}


def bucket(v: Column) -> Column:
    """0 for 0, else 1 + ceil(log_gamma(v))."""
    return F.when(v <= 0, F.lit(0)).otherwise(F.lit(1) + F.ceil(F.log(v.cast("double")) / F.lit(math.log(GAMMA)))).cast("int")


def bucket_value(b: Column) -> Column:
    """The middle of a bucket, as the sketch reports it."""
    return F.when(b == 0, F.lit(0.0)).otherwise(F.lit(2.0 / (GAMMA + 1)) * F.pow(F.lit(GAMMA), b - 1))


def fences(counted: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """One row per (_lang, _source) with lower/upper fences of each rate."""
    long = F.explode(F.array(*[F.struct(F.lit(k).alias("rate"), bucket(v).alias("b")) for k, v in rates().items()]))
    sketch = (counted.select("_lang", "_source", long.alias("x")).select("_lang", "_source", "x.rate", "x.b")
              .groupBy("_lang", "_source", "rate", "b").agg(F.count("*").alias("n")))
    sketch = cut(sketch)
    levels = [sketch.withColumn("level", F.lit(0)),
              sketch.groupBy("_lang", "rate", "b").agg(F.sum("n").alias("n")).withColumn("_source", F.lit("")).withColumn("level", F.lit(1)),
              sketch.groupBy("rate", "b").agg(F.sum("n").alias("n")).withColumn("_lang", F.lit("")).withColumn("_source", F.lit("")).withColumn("level", F.lit(2))]
    s = levels[0].unionByName(levels[1]).unionByName(levels[2])
    key = ["level", "_lang", "_source", "rate"]
    run = W.partitionBy(*key).orderBy("b")
    s = s.withColumn("cum", F.sum("n").over(run)).withColumn("total", F.sum("n").over(W.partitionBy(*key)))
    q = (s.groupBy(*key, "total").agg(*[F.min(F.when(F.col("cum") >= F.col("total") * p, F.col("b"))).alias(a)
                                        for p, a in ((0.25, "q1"), (0.75, "q3"))]))
    spread = F.greatest(bucket_value(F.col("q3")) - bucket_value(F.col("q1")),
                        F.element_at(F.create_map(*[F.lit(x) for k, v in RATES.items() for x in (k, float(v[0]))]), F.col("rate")))
    q = q.select("level", "_lang", "_source", "rate", "total", (bucket_value(F.col("q1")) - FENCE * spread).alias("lo"),
                 (bucket_value(F.col("q3")) + FENCE * spread).alias("hi"))

    def wide(level, keys, suffix):
        aggs = [F.max(F.when(F.col("rate") == r, F.col(x))).alias(f"{x}_{r}{suffix}") for r in RATES for x in ("lo", "hi")]
        return q.where(F.col("level") == level).groupBy(*keys).agg(F.max("total").alias(f"n{suffix}"), *aggs)

    g = (wide(0, ["_lang", "_source"], "0").join(wide(1, ["_lang"], "1"), "_lang")
         .crossJoin(F.broadcast(wide(2, [], "2"))))        # one row
    pick = lambda c: (F.when(F.col("n0") >= least_docs, F.col(f"{c}0"))
                      .when(F.col("n1") >= least_docs, F.col(f"{c}1")).otherwise(F.col(f"{c}2")).alias(c))
    return g.select("_lang", "_source", *[pick(f"{x}_{r}") for r in RATES for x in ("lo", "hi")])


def judge(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``docs`` (doc_id, text, lang, source) -> doc_id, row hash, counts,
    base_failed, kept; the text itself is read once and not carried."""
    key = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")).alias(f"_{c}")  # noqa: E731  null apart from ''
    d = with_counts(docs.select("doc_id", "text", "lang", "source"))
    d = cut(d.select("doc_id", F.xxhash64("text").alias("text_hash"), key("lang"), key("source"), *COUNTS))
    judged = d.join(fences(d, least_docs), ["_lang", "_source"])
    fine = F.lit(True)
    for r, v in rates().items():
        fine &= v <= F.col(f"hi_{r}")
        if RATES[r][1]:
            fine &= v >= F.col(f"lo_{r}")
    return judged.select("doc_id", "text_hash", *COUNTS, base_failed().alias("base_failed"),
                         (~base_failed() & fine).alias("kept"))


def keep_good(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The documents that pass, with all their columns."""
    bad = (judge(docs, least_docs).where(~F.col("kept"))
           .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_t")).distinct())
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_t")), "left_anti")
