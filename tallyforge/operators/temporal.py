"""Before/after extremes against another table's dates (as-of lookups).

The reports ask, for every (person, event) pair, for the MIN of a value
recorded on or before the event's start and the MAX recorded on or after
its end.  Written as in the text -- join every value row to every event
row of the same person, then aggregate -- the join emits |values| x
|events| rows per person, quadratic in a busy person's history.

Here values, starts and ends are one tagged union, reduced to one row per
(key, day) by a single aggregate: the day's min and max and which probes ask
for it.  Over one exchange by key, two running windows (min ascending, max
descending) give both answers at each probed day.  A key's window holds at
most one row per distinct day, so its size is bounded by the calendar, not by
how many rows the key has: a hot key is combined map-side before it moves.
The answers are joined back 1:1 on (key, day), where AQE may split a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def extremes_around(values: DataFrame, probes: DataFrame, key: str, value_date: str, value: str,
                    start: str, end: str, before: str = "before", after: str = "after") -> DataFrame:
    """Append to every ``probes`` row ``before`` = MIN(value) over the value
    rows of its key dated <= its ``start``, and ``after`` = MAX(value) over
    those dated >= its ``end`` (NULL when none, or when the probe date is
    NULL).  Probe rows and their other columns are returned unchanged.
    """
    kind = values.schema[value].dataType
    rows = values.select(F.col(key), F.col(value_date).alias("_d"), F.col(value).alias("_v"), F.lit(False).alias("_asked"))
    asked = probes.select(F.col(key), F.explode(F.array(start, end)).alias("_d"))
    rows = rows.unionByName(asked.select(key, "_d", F.lit(None).cast(kind).alias("_v"), F.lit(True).alias("_asked")))
    days = rows.where(F.col("_d").isNotNull()).groupBy(key, "_d").agg(
        F.min("_v").alias("_vmin"), F.max("_v").alias("_vmax"), F.max("_asked").alias("_asked"))
    run = Window.partitionBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a day is one row, so "<=" and ">=" include that day's values
    days = days.select(key, "_d", "_asked", F.min("_vmin").over(run.orderBy(F.col("_d").asc())).alias(before),
                       F.max("_vmax").over(run.orderBy(F.col("_d").desc())).alias(after))
    # asking for both keeps both windows in either reader below, so that they share one exchange
    days = days.where(F.col("_asked") & (F.col(before).isNotNull() | F.col(after).isNotNull()))
    b = days.select(key, F.col("_d").alias(start), before)
    a = days.select(key, F.col("_d").alias(end), after)
    return probes.join(b, [key, start], "left").join(a, [key, end], "left")
