"""Weighted scores and whole-result maxima."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weighted_score(terms: Sequence[tuple[float, Column]], dtype: str | None = None) -> Column:
    """``w1*t1 + w2*t2 + ...``; NULL if any term is NULL (as in the text)."""
    total = None
    for w, t in terms:
        term = F.lit(float(w)) * t.cast("double")
        total = term if total is None else total + term
    return total.cast(dtype) if dtype else total


def global_max(df: DataFrame, cols: Mapping[str, str | Column]) -> DataFrame:
    """One-row frame ``{name: max(col)}`` (an uncorrelated scalar subquery)."""
    return df.agg(*[F.max(c if isinstance(c, Column) else F.col(c)).alias(n)
                    for n, c in cols.items()])


def with_global_max(df: DataFrame, cols: Mapping[str, str | Column],
                    source: DataFrame | None = None) -> DataFrame:
    """Attach whole-result maxima as columns.

    ``MAX(x) OVER ()`` makes Spark move every row into one partition.  The
    same value comes from a global aggregate (partial max per partition,
    then one row), which is broadcast -- its size is one row by
    construction -- and cross-joined onto ``df`` without moving ``df``.
    """
    maxima = global_max(source if source is not None else df, cols)
    return df.crossJoin(F.broadcast(maxima))
