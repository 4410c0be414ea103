"""Structured Streaming forms: runners, sinks, staged operators and windows."""

from eventlytics.streaming.sinks import End, console, run_available_now, stream_result, top_k_stream, write_sides
from eventlytics.streaming.staged import StagedStream, staged_stream
from eventlytics.streaming.unique import reconcile_unique
from eventlytics.streaming.windows import count_stream, distinct_stream, field_sum_stream, reconcile_stream

__all__ = ["End", "StagedStream", "console", "count_stream", "distinct_stream", "field_sum_stream", "reconcile_stream",
           "reconcile_unique", "run_available_now", "staged_stream", "stream_result", "top_k_stream", "write_sides"]
