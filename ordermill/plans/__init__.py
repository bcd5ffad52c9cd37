"""Dimensional models, cross-source queries, metrics and the full build."""
