"""Composite jobs and the helpers that decide how a join side is shipped."""
