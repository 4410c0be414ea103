"""Operators: each a function from DataFrame(s) to DataFrame."""

from eventlytics.operators.aggregates import Aggregate, aggregate_by
from eventlytics.operators.candidates import top_k_by_candidates, window_candidates
from eventlytics.operators.consuming import reconcile_consuming
from eventlytics.operators.late import late_rows, window_count_with_late, with_closed_windows, with_seen_before
from eventlytics.operators.patterns import adjacent_pair_within, pattern_matches, pattern_outcomes, pattern_timeout
from eventlytics.operators.reconcile import reconcile, split_status
from eventlytics.operators.sketches import hll_bound, window_distinct_both, window_distinct_estimate
from eventlytics.operators.timers import failure_burst, flush_buckets, single_slot_timeout
from eventlytics.operators.topk import rank_report, top_k_per_window
from eventlytics.operators import durations
from eventlytics.operators.windows import (
    window_count, window_distinct, window_distinct_sliding, window_field_sum, windowed_count,
)

__all__ = [
    "durations", "adjacent_pair_within", "pattern_matches", "pattern_outcomes",
    "pattern_timeout", "reconcile", "split_status",
    "failure_burst", "flush_buckets", "single_slot_timeout", "rank_report", "top_k_per_window",
    "top_k_by_candidates", "window_candidates",
    "window_count", "window_distinct", "window_distinct_sliding", "window_field_sum", "windowed_count",
    "Aggregate", "aggregate_by", "hll_bound", "window_distinct_both", "window_distinct_estimate",
    "late_rows", "reconcile_consuming", "window_count_with_late", "with_closed_windows", "with_seen_before",
]
