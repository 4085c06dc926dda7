"""Column helpers (all JVM-side built-ins; no Python UDFs)."""

from .aggs import (  # noqa: F401
    avg_ratio_skip_zero, count_distinct_ids, count_where, guarded_corr, id_list, id_text, max_where, min_where,
    signed_sum, sum_where, trunc_avg, weighted_sum,
)
from .scalar import dec, days_between, ifnull, pct, ratio, recent, round_exact  # noqa: F401
