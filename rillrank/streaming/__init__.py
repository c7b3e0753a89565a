"""Structured Streaming sinks, stateful processors and micro-batch steps."""
