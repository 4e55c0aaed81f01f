"""Composite plans: marts, interactive analysis, checks, loading and publishing."""
