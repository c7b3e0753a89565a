"""Whole jobs, one function each."""
