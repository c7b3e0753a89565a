"""Column helpers and record parsing."""
