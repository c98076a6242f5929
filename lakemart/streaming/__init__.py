"""Structured Streaming runs of the batch transforms."""
