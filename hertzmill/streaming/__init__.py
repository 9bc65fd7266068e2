"""Structured Streaming forms of the lookups."""
