"""Positions and LAG over results of any size, without a window that holds
them all.

Rows are sorted by ranges (``orderBy``: a range exchange, each task one
range) and written once with their task and place in it.  What crosses tasks
is one row for each task: the number of rows before it, or the last values
before it.  A hot parent or a run of equal keys spreads over ranges by the
further order columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .once import compute_once

PLACE = (1 << 33) - 1        # monotonically_increasing_id: task << 33 | place in the task


def _order(spec: str) -> Column:
    """``name`` ascending with NULLs first, ``-name`` descending, NULLs last."""
    return F.col(spec[1:]).desc_nulls_last() if spec.startswith("-") else F.col(spec).asc_nulls_first()


def _sorted_once(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` with ``_task`` and ``_place`` of its sorted rows."""
    rows = df.orderBy(*[_order(c) for c in order]).withColumn("_id", F.monotonically_increasing_id())
    rows = rows.withColumn("_task", F.shiftright("_id", 33)).withColumn("_place", F.col("_id").bitwiseAND(F.lit(PLACE)))
    return compute_once(rows.drop("_id"))


def with_position(df: DataFrame, order: Sequence[str], within: Sequence[str] = (), out: str = "position") -> DataFrame:
    """``df`` with each row's place, from 1, in the given order (``-name``
    descending) -- of the whole result, or within equal values of the
    ``within`` columns (NULLs are equal).  Rows that the order doesn't tell
    apart get places in any order."""
    within = list(within)
    rows = _sorted_once(df, [*within, *order])
    tasks = rows.groupBy("_task").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)          # a row for each task
    tasks = tasks.select("_task", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = rows.join(tasks, "_task").withColumn(out, F.col("_before") + F.col("_place") + 1).drop("_task", "_place", "_before")
    if not within:
        return placed
    firsts = placed.groupBy(*[F.col(c).alias(f"_{i}") for i, c in enumerate(within)]).agg(F.min(out).alias("_first"))
    same = F.lit(True)
    for i, c in enumerate(within):
        same = same & F.col(c).eqNullSafe(F.col(f"_{i}"))
    return placed.join(firsts, same).select(*df.columns, (F.col(out) - F.col("_first") + 1).alias(out))


def with_lag(df: DataFrame, order: Sequence[str], col: str, out: str) -> DataFrame:
    """``LAG(col) OVER (ORDER BY ...)`` of the whole result: within a task by
    a window over its range, and a task's first row takes the last value of
    the nearest task before it that has rows.  NULL values are carried like
    others; only the first row has none."""
    rows = _sorted_once(df, order)
    ends = rows.groupBy("_task").agg(F.max(F.struct("_place", F.col(col).alias("v"))).alias("_end"))
    ends = ends.select("_task", F.lag("_end.v").over(Window.orderBy("_task")).alias("_carried"))     # a row for each task
    inside = Window.partitionBy("_task").orderBy("_place")
    rows = rows.withColumn(out, F.lag(col).over(inside)).join(ends, "_task")
    return rows.withColumn(out, F.when(F.col("_place") == 0, F.col("_carried")).otherwise(F.col(out))).drop("_task", "_place", "_carried")
