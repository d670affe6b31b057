"""Structured Streaming variants of the linkage operators."""
