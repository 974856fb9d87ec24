"""Operators for large-scale text pipelines (see README, "Text operators")."""
