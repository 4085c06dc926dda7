"""Scalar Column helpers for the T-SQL idioms the reports use."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def ifnull(value, default) -> Column:
    """Two-argument ISNULL: ``coalesce`` (Spark's ``isnull`` is one-argument)."""
    return F.coalesce(_c(value), default if isinstance(default, Column) else F.lit(default))


def ratio(num, den, guard: int | None = 0, scale: float = 1.0,
          dtype: str | None = None) -> Column:
    """``num * scale / NULLIF(den, guard)`` computed in double precision.

    ``guard`` is the value NULLIF maps to NULL: the reports use both 0 (a
    true divide guard) and 1 (which NULLs a denominator of one and leaves a
    zero denominator unguarded).  ``try_divide`` turns the unguarded zero
    into NULL instead of failing the job under ANSI mode.  ``dtype`` casts
    the result (e.g. ``decimal(5,2)``), rounding half up.
    """
    den_c = _c(den).cast("double")
    if guard is not None:
        den_c = F.nullif(den_c, F.lit(float(guard)))
    out = F.try_divide(_c(num).cast("double") * F.lit(float(scale)), den_c)
    return out.cast(dtype) if dtype else out


def pct(num, den, guard: int | None = 0, dtype: str | None = "decimal(5,2)") -> Column:
    """Percentage ``num * 100.0 / NULLIF(den, guard)``."""
    return ratio(num, den, guard=guard, scale=100.0, dtype=dtype)


def days_between(start, end) -> Column:
    """T-SQL ``DATEDIFF(DAY, start, end)``: day boundaries crossed.

    Spark's 2-argument ``datediff(end, start)`` compares calendar dates,
    which is exactly the boundary count (the 3-argument form counts whole
    24 h periods instead).
    """
    return F.datediff(_c(end), _c(start))


def recent(col, as_of: str | _dt.datetime, days: int) -> Column:
    """``col > DATEADD(DAY, -days, as_of)`` with a fixed ``as_of`` instant.

    ``as_of`` replaces the wall clock so a run can be repeated.  The bound is
    a timestamp: ``date_sub`` would drop the time of day.
    """
    bound = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    return _c(col).cast("timestamp_ntz") > bound


EXACT = "decimal(38,10)"


def round_exact(col, scale: int = 2) -> Column:
    """``ROUND(x, scale)`` of a T-SQL NUMERIC expression.

    The text's ``x * 1.0 / y * 0.4 + ...`` is exact decimal arithmetic, so
    a value like 2.155 rounds half up to 2.16; the same sum in doubles is
    2.15499... and would round down.  Rounding the decimal form keeps the
    text's result; the value is returned as double.
    """
    return F.round(_c(col).cast(EXACT), scale).cast("double")


def dec(value: str) -> Column:
    """An exact decimal literal (``F.lit(0.2)`` would be a double)."""
    from decimal import Decimal
    return F.lit(Decimal(value))
