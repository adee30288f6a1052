"""Composed pipelines (pure DataFrame -> DataFrame functions)."""
