"""Column-level helpers (all built-in Spark expressions, JVM side)."""

from eventlytics.functions.text import rank_line
from eventlytics.functions.time import epoch_ms, event_time_from, window_end_ms, with_event_time

__all__ = ["epoch_ms", "event_time_from", "window_end_ms", "with_event_time", "rank_line"]
