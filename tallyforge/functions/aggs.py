"""Aggregate Column helpers.

All of them are built from ``sum``/``count``/``min``/``max``/``avg`` and
``collect_list`` so that Spark plans a partial (map-side) aggregate before
the shuffle; only the id-list helpers keep per-row data in the buffer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scalar import _c


def count_where(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``.

    Not ``count_if``: over an empty group (e.g. a global aggregate of no
    rows) the SUM form is NULL while a count would be 0.
    """
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def sum_where(value, cond: Column, otherwise=0) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE otherwise END)``."""
    return F.sum(F.when(cond, _c(value)).otherwise(F.lit(otherwise)))


def signed_sum(value, code, plus: str, minus: str) -> Column:
    """+value when ``code = plus``, -value when ``code = minus``, else 0."""
    v = _c(value)
    return F.sum(F.when(_c(code) == plus, v).when(_c(code) == minus, -v).otherwise(F.lit(0)))


def weighted_sum(qty, category, weights: Mapping[str, float], default: float) -> Column:
    """``SUM(qty * weight(category))`` with a default weight."""
    w = None
    for cat, wt in weights.items():
        w = (F.when(_c(category) == cat, F.lit(wt)) if w is None
             else w.when(_c(category) == cat, F.lit(wt)))
    w = F.lit(default) if w is None else w.otherwise(F.lit(default))
    return F.sum(_c(qty) * w)


def trunc_avg(col) -> Column:
    """Integer AVG as SQL Server computes it for an int column: truncated."""
    c = _c(col)
    return F.call_function("div", F.sum(c), F.nullif(F.count(c), F.lit(0)))


def min_where(value, cond: Column) -> Column:
    """``MIN(CASE WHEN cond THEN value END)`` (no ELSE: others are NULL)."""
    return F.min(F.when(cond, _c(value)))


def max_where(value, cond: Column) -> Column:
    """``MAX(CASE WHEN cond THEN value END)``."""
    return F.max(F.when(cond, _c(value)))


def avg_ratio_skip_zero(num, den) -> Column:
    """``AVG(CASE WHEN den = 0 THEN NULL ELSE CAST(num AS FLOAT) / den END)``."""
    d = _c(den).cast("double")
    return F.avg(F.when(d != 0, _c(num).cast("double") / d))


def count_distinct_ids(df: DataFrame, keys: Sequence[str], ids: Mapping[str, str], more: Sequence[Column] = ()) -> DataFrame:
    """Several exact ``COUNT(DISTINCT id)`` of integer columns per key, with
    other aggregates (``more``) beside them.

    ``countDistinct`` of several columns copies each row once per count
    (Expand) and shuffles every distinct (key, id).  Here ids are bits of
    64-bit words, or-ed map-side: a row for each (key, id // 64), one word
    for up to 64 ids and never more rows than distinct ids, whose set bits
    are counted.  Each count scans its own column.  Null ids aren't counted,
    negative ones are ids like others; null keys are a group.
    """
    keys = list(keys)
    out = df.groupBy(*keys).agg(*(list(more) or [F.count(F.lit(1)).alias("_rows")]))
    for name, c in ids.items():
        v = F.col(c).cast("long")
        word = F.call_function("shiftleft", F.lit(1).cast("long"), v.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        words = (df.select(*keys, F.shiftright(v, 6).alias("_at"), word.alias("_bit")).where(F.col("_at").isNotNull())
                 .groupBy(*keys, "_at").agg(F.bit_or("_bit").alias("_bits")))
        n = words.groupBy(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)]).agg(F.sum(F.bit_count("_bits")).cast("long").alias("_n"))
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"_{i}"))
        out = out.join(n, same, "left").select(*out.columns, F.coalesce("_n", F.lit(0).cast("long")).alias(name))
    return out.drop("_rows")


def id_list(col, distinct: bool = False) -> Column:
    """STRING_AGG of ids as a sorted array (NULLs skipped, duplicates kept).

    The order of STRING_AGG without WITHIN GROUP is undefined; sorting makes
    the output deterministic.  The array lives in one aggregation buffer per
    key, so this belongs only where one row per parent is the feature.
    """
    agg = F.collect_set(_c(col)) if distinct else F.collect_list(_c(col))
    return F.array_sort(agg)


def id_text(col, sep: str = ",") -> Column:
    """The same list as comma text (``STRING_AGG(CAST(id AS VARCHAR), ',')``)."""
    arr = id_list(col)
    return F.when(F.size(arr) > 0, F.array_join(F.transform(arr, lambda x: x.cast("string")), sep))


def guarded_corr(x, y) -> Column:
    """``CASE WHEN STDEV_SAMP(x) = 0 OR STDEV_SAMP(y) = 0 THEN NULL
    ELSE COVAR_SAMP(x, y) / (STDEV_SAMP(x) * STDEV_SAMP(y)) END``.

    Not ``corr``: under ANSI mode it fails on zero variance, and it drops a
    row when either side is NULL for the variances too, while the text
    takes each deviation over its own non-NULL values.  Zero variance is
    decided by ``min = max``, which is exact where a computed variance may
    carry rounding noise.  All five pieces are partial aggregates.
    """
    xc, yc = _c(x).cast("double"), _c(y).cast("double")
    flat = (F.min(xc) == F.max(xc)) | (F.min(yc) == F.max(yc))
    return F.when(flat, F.lit(None).cast("double")).otherwise(
        F.covar_samp(xc, yc) / (F.stddev_samp(xc) * F.stddev_samp(yc)))
