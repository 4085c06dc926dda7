"""Factorised forms of many-to-many fan-outs.

Several reports join two child tables on a shared key and then aggregate,
so every child row is repeated once per partner row (a per-key cross
product).  At scale that product is quadratic in the key's size and a hot
key alone can exceed any executor.  The functions here compute *the same
aggregates* from per-key summaries of each side, joined one row to one
row:

* ``within_key_zero_corr`` -- correlation over a full per-key cross
  product (the covariance of independent repeats is exactly 0);
* ``cross_moments`` -- sums, counts and the guarded correlation of a
  left-joined fan-out, from per-bridge-key moments;
* ``fanout`` helpers -- multiplicity factors ``max(n, 1)`` that say how
  often a row is repeated by a left join.

Each is checked against the naive join in the test suite and by the
DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _null_double() -> Column:
    return F.lit(None).cast("double")


def within_key_zero_corr(x_df: DataFrame, y_df: DataFrame, key: str | Sequence[str],
                         x: str, y: str, out: str) -> DataFrame:
    """Guarded correlation of ``x`` and ``y`` over ``x_df JOIN y_df USING key``.

    Inside a key every x row meets every y row, so x and y are independent
    repeats and their sample covariance is 0 whenever it is defined.  The
    guarded form ``CASE WHEN sd_x = 0 OR sd_y = 0 THEN NULL ELSE cov /
    (sd_x * sd_y) END`` is therefore 0.0 when both sides vary (min != max
    over non-NULL values) and NULL otherwise.  Keys absent from either side
    produce no row, as in the inner join.  Cost: two partial aggregates and
    a 1:1 join instead of |x| * |y| rows per key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    xs = x_df.groupBy(*keys).agg(F.min(x).alias("_xmin"), F.max(x).alias("_xmax"))
    ys = y_df.groupBy(*keys).agg(F.min(y).alias("_ymin"), F.max(y).alias("_ymax"))
    vary = (F.col("_xmin") != F.col("_xmax")) & (F.col("_ymin") != F.col("_ymax"))
    return xs.join(ys, keys).select(
        *keys, F.when(vary, F.lit(0.0)).otherwise(_null_double()).alias(out))


def _moments(df: DataFrame, key: str, v: str, p: str, shift: Column) -> DataFrame:
    c = F.col(v).cast("double") - shift
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(f"{p}_rows"),
        F.count(c).alias(f"{p}_n"),
        F.sum(c).alias(f"{p}_s"),
        F.sum(c * c).alias(f"{p}_ss"),
        F.min(F.col(v)).alias(f"{p}_min"),
        F.max(F.col(v)).alias(f"{p}_max"))


def cross_moments(x_df: DataFrame, y_df: DataFrame, bridge: str, group: str,
                  x: str, y: str, extra_x: Mapping[str, Column] | None = None,
                  out_corr: str = "corr") -> DataFrame:
    """Aggregates of ``x_df LEFT JOIN y_df USING (bridge)`` grouped by ``group``.

    ``x_df`` holds (bridge, group, x, ...) -- the left side, already carrying
    its group attribute; ``y_df`` holds (bridge, y).  With n rows of x and m
    rows of y under one bridge key the join yields n * max(m, 1) rows: each
    x row repeated M = max(m, 1) times, each non-NULL y repeated n times,
    and nx * ny (x, y) pairs with both sides non-NULL.  Per group:

    * ``rows``      = sum n * M (the joined row count)
    * ``x_sum``     = sum over joined rows of x
    * ``extra_x``   = further per-row sums of the left side, weighted by M
    * ``corr``      = guarded sample correlation of x and y over the rows,
      each standard deviation over its own non-NULL values and the
      covariance over pairs -- from per-bridge moments combined as
      cov = (Sxy - Sx Sy / P) / (P - 1), with Sxy = sum Sx_b * Sy_b.

    Values are centred on their global means (one-row aggregates) before
    the sums of squares, which keeps the subtraction well conditioned.
    Zero variance is decided exactly by min = max.
    """
    extra_x = dict(extra_x or {})
    sx = x_df.agg(F.avg(F.col(x).cast("double")).alias("_x_shift"))
    sy = y_df.agg(F.avg(F.col(y).cast("double")).alias("_y_shift"))
    xb = x_df.crossJoin(F.broadcast(sx))
    xm = xb.groupBy(bridge, group).agg(
        F.count(F.lit(1)).alias("x_rows"),
        F.count(F.col(x)).alias("x_n"),
        F.sum(F.col(x)).alias("x_raw"),
        F.sum(F.col(x).cast("double") - F.col("_x_shift")).alias("x_s"),
        F.sum(F.pow(F.col(x).cast("double") - F.col("_x_shift"), 2)).alias("x_ss"),
        F.min(F.col(x)).alias("x_min"), F.max(F.col(x)).alias("x_max"),
        *[F.sum(c).alias(f"_extra_{k}") for k, c in extra_x.items()])
    yb = y_df.crossJoin(F.broadcast(sy))
    ym = _moments(yb, bridge, y, "y", F.col("_y_shift"))
    j = xm.join(ym, bridge, "left")
    M = F.greatest(F.coalesce(F.col("y_rows"), F.lit(0)), F.lit(1))
    n = F.col("x_rows")
    ny = F.coalesce(F.col("y_n"), F.lit(0))
    g = j.groupBy(group).agg(
        F.sum(n * M).alias("rows"),
        F.sum(F.col("x_raw") * M).alias("x_sum"),
        *[F.sum(F.col(f"_extra_{k}") * M).alias(k) for k in extra_x],
        # x over joined rows (each repeated M times)
        F.sum(F.col("x_n") * M).alias("_nx"),
        F.sum(F.col("x_s") * M).alias("_sx"),
        F.sum(F.col("x_ss") * M).alias("_sxx"),
        # y over joined rows (each repeated n times)
        F.sum(n * ny).alias("_ny"),
        F.sum(n * F.coalesce(F.col("y_s"), F.lit(0.0))).alias("_sy"),
        F.sum(n * F.coalesce(F.col("y_ss"), F.lit(0.0))).alias("_syy"),
        # pairs with both non-NULL
        F.sum(F.col("x_n") * ny).alias("_p"),
        F.sum(F.col("x_s") * F.coalesce(F.col("y_s"), F.lit(0.0))).alias("_pxy"),
        F.sum(F.col("x_s") * ny).alias("_px"),
        F.sum(F.col("x_n") * F.coalesce(F.col("y_s"), F.lit(0.0))).alias("_py"),
        F.min("x_min").alias("_xmin"), F.max("x_max").alias("_xmax"),
        F.min(F.when(n > 0, F.col("y_min"))).alias("_ymin"),
        F.max(F.when(n > 0, F.col("y_max"))).alias("_ymax"))
    var_x = F.try_divide(F.col("_sxx") - F.col("_sx") * F.col("_sx") / F.col("_nx"), F.col("_nx") - 1)
    var_y = F.try_divide(F.col("_syy") - F.col("_sy") * F.col("_sy") / F.col("_ny"), F.col("_ny") - 1)
    cov = F.try_divide(F.col("_pxy") - F.col("_px") * F.col("_py") / F.col("_p"), F.col("_p") - 1)
    flat = (F.col("_xmin") == F.col("_xmax")) | (F.col("_ymin") == F.col("_ymax"))
    defined = (F.col("_nx") > 1) & (F.col("_ny") > 1) & (F.col("_p") > 1)
    corr = (F.when(flat, _null_double())
             .when(defined, cov / (F.sqrt(var_x) * F.sqrt(var_y)))
             .otherwise(_null_double()))
    return g.select(group, "rows", "x_sum", *extra_x.keys(), corr.alias(out_corr))


def repeat_factor(count_col: Column) -> Column:
    """How often a left row is repeated by a LEFT JOIN to ``count`` partners."""
    return F.greatest(F.coalesce(count_col, F.lit(0)), F.lit(1))
