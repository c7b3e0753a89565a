"""Keyed-stream analytics on Spark: windows, top-N, running aggregates, alerts."""
