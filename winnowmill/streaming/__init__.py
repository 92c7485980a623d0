"""Structured Streaming forms of the row operators."""
