"""Batch and stream DataFrame operators."""
