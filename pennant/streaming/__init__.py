"""Structured Streaming operators (SS1-SS5)."""
