"""eventlytics: event-time analytics over click, access-log, login and order
events as Spark DataFrame operators (batch and Structured Streaming)."""

__version__ = "0.1.0"
