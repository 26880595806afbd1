"""Structured Streaming forms of the operators, and declared jobs."""
