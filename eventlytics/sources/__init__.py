"""Sources and sinks: text files, in-memory rows, Kafka topics, driver tables."""

from eventlytics.sources.files import (
    number_lines, parse_access_log, parse_behavior, read_access_log, read_behavior, read_lines, split_quarantine,
)
from eventlytics.sources.memory import rows_to_frame, rows_to_stream

__all__ = [
    "number_lines", "parse_access_log", "parse_behavior", "read_access_log", "read_behavior",
    "read_lines", "split_quarantine", "rows_to_frame", "rows_to_stream",
]
